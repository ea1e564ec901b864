"""Spelling variants: the full neighbourhood of every word, looked up in the vocabulary.

Method. For each word of the vocabulary all distinct strings one deletion, replacement or insertion away are made over
the observed alphabet and looked up among the words by hash. What is found is at distance one as it was made so; no
distance is computed.

A neighbourhood has hundreds of strings, so they are made where the words are that they can meet. Strings that differ
by one edit agree outside of it: a word of m code points is cut into regions of at most REGION code points (longer
ones in words of over REGION * MOST_REGIONS), and stands once for each region under a key of its length, the region
and everything outside of it. A word that looks for others goes, for each region of the wanted lengths (its own, one
less, one more), to the same key, and its edits inside the region are looked up in a hash table of the words there.
A task then makes edits of a few code points over the letters seen in these words: what holds another letter is not
in the table. Every edit falls into a region, so nothing is lost; finds that fall into two are made distinct.

Scale. A word is shuffled once for each region and role, four times its length over REGION, and no candidate is. A
group holds the words that agree outside one region of REGION code points, so its size is bounded by the alphabet to
that power, not by the corpus; it is worked off as a stream sorted by key. In words of over REGION * MOST_REGIONS (96)
code points regions are longer, as else their rows would grow with the square of their length; there only the words
that really share all the rest stand together. Counts are combined in each task before they are shuffled.

Edges. A null text has no words; a null doc_id counts as an empty one in the hash. Repeated rows count as often as
they stand. Ties of forms go to the smaller word in code-point order. Empty tables give no rows. Only doc_id and text
are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _util as ut

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A near word is a word's form if it is so many times as frequent.
TIMES = 5
REGION = 3
MOST_REGIONS = 32
#: Every so manieth run of a document loses a code point.
DAMAGED = 199
#: Distinct words that a task counts before it sends them, and code points of a text that are searched at once.
HELD = 1 << 18
_LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


def _damaged(run: str, base: int) -> str:
    h = zlib.crc32(run.encode(), base)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of (doc_id, text) with enough code points and occurrences, as a table of the shared folder."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw").cast(pa.binary()), strict=True):
                text = raw.as_py().translate(_LOWER).decode()
                base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                found = Counter(_LETTERS.findall(text) if len(text) < HELD else (m.group() for m in _LETTERS.finditer(text)))
                for run, n in found.items():
                    # A run that is too short after the loss of a code point is so before.
                    if len(run) >= least_length:
                        held[_damaged(run, base)] += n
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    own = ut.only(docs, doc_id="long", text="string").where("text is not null").select("doc_id", F.col("text").alias("raw"))
    words = own.mapInArrow(count, "word string, n long").where(F.length("word") >= least_length)
    return ut.materialize(words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "vocabulary")


def edits(s: str, role: int, letters: str) -> set[str]:
    """All distinct strings one replacement (0), deletion (1) or insertion (2) away from s over some letters."""
    if role == 0:
        return {s[:i] + c + s[i + 1 :] for i in range(len(s)) for c in letters if c != s[i]}
    if role == 1:
        return {s[:i] + s[i + 1 :] for i in range(len(s))}
    return {s[:i] + c + s[i:] for i in range(len(s) + 1) for c in letters}


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) for all ordered pairs of distinct words (word, n) one edit apart, each once."""
    # Of a wanted length m: the region [lo, hi) of the other word, and what of this one stands before and after it.
    length = F.length("word")
    rows = words.select("word", "n", length.alias("own"), F.explode(F.expr("array(-1, 0, 1, 2)")).alias("role"))
    # Role -1 is the word itself, there to be found; 0, 1 and 2 look for words of m code points by an edit.
    rows = rows.withColumn("m", F.col("own") + F.expr("case role when 1 then -1 when 2 then 1 else 0 end")).where("m > 0")
    width = F.greatest(F.lit(REGION), F.ceil(F.col("m") / MOST_REGIONS)).cast("int")
    rows = rows.withColumn("width", width).withColumn("lo", F.explode(F.expr("sequence(0, m - 1, width)")))
    rows = rows.withColumn("hi", F.least(F.col("lo") + F.col("width"), F.col("m"))).withColumn("after", F.col("m") - F.col("hi"))
    rest = F.concat(F.expr("substring(word, 1, lo)"), F.lit("\u0000"), F.expr("substring(word, own - after + 1, after)"))
    rows = rows.select(
        F.unhex(F.substring(F.sha2(F.concat_ws("\u0000", "m", "lo", rest), 256), 1, 32)).alias("k"), F.col("role").cast("byte").alias("role"),
        F.expr("substring(word, lo + 1, own - after - lo)").alias("middle"), "word", "n",
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table, letters = None, {}, ""
        out: list[tuple] = []
        seen: dict[tuple[str, int], list] = {}

        def rows_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["word", "n", "other", "other_n"])

        for batch in batches:
            for k, role, middle, word, n in zip(*(batch.column(c).to_pylist() for c in ("k", "role", "middle", "word", "n")), strict=True):
                if k != now:
                    now, table, letters, seen = k, {}, None, {}
                if role < 0:
                    table[middle] = (word, n)
                    continue
                # Nobody to meet: a group of this word alone, or of none.
                if not table or (role == 0 and len(table) == 1):
                    continue
                if letters is None:
                    letters = "".join(set("".join(table)))
                found = seen.get((middle, role))
                if found is None:
                    found = seen[middle, role] = [table[x] for x in edits(middle, role, letters) if x in table]
                for other, other_n in found:
                    out.append((word, n, other, other_n))
                if len(out) >= HELD:
                    yield rows_of()
                    out = []
        if out:
            yield rows_of()

    found = rows.repartition("k").sortWithinPartitions("k", "role").mapInArrow(look, "word string, n long, other string, other_n long")
    return found.dropDuplicates(["word", "other"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): what is reached by following forms, by pointer doubling.

    Counts grow along a chain, so it has no cycle; a chain of length d takes log2(d) + 1 rounds, each a join of the
    words that have a form.
    """
    at = ut.materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = ut.materialize(moved, "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (doc_id, text)."""
    words = vocabulary(docs, least_length, least_count)
    best = F.min(F.struct((-F.col("other_n")).alias("falling"), F.col("other").alias("other"))).alias("best")
    near = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    form_n = -F.col("best.falling")
    formed = form_n >= F.col("n") * times
    near = near.select("word", "n_near", F.when(formed, F.col("best.other")).alias("form"), F.when(formed, form_n).alias("form_n"))
    near = ut.materialize(near, "near")
    last = roots(near.where("form is not null"))
    out = words.join(near, "word", "left").join(last, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return variants(ut.table(spark, sf_dir, "documents"))


#: CRCs byte by byte from a table that is made by its rule; near words meet under patterns with one place open.
SQL = r"""
with recursive bits(i, step, c) as (select i, 0, i::bigint from range(256) as r(i) union all select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where step < 8),
 t as materialized (select list(c order by i) as t from bits where step = 8),
 d as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents),
 e as (select doc_id, run, count(*) as n from d where length(run) >= 6 group by all),
 x as (select run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from e),
 h as (select run, n, xor(list_reduce(list_transform(range(0, length(x), 2), lambda i: ('0x' || x[i + 1 : i + 2])::bigint), lambda c, b: xor(c >> 8, t.t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) as h from x, t),
 w as (select word, sum(n)::bigint as n from (select case when h % 199 = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 :] else run end as word, n from h) where length(word) >= 6 group by word having sum(n) >= 5),
 k as (select distinct word, n, kind, p from (select word, n, 'open' as kind, unnest(list_transform(range(1, length(word) + 1), lambda i: word[1 : i - 1] || '*' || word[i + 1 :])) as p from w
   union all select word, n, 'less' as kind, unnest(list_transform(range(1, length(word) + 1), lambda i: word[1 : i - 1] || word[i + 1 :])) as p from w)),
 o as (select a.word, a.n, b.word as other, b.n as m from k a join k b on a.kind = 'open' and b.kind = 'open' and a.p = b.p and a.word <> b.word
   union select a.word, a.n, b.word, b.n from k a join w b on a.kind = 'less' and a.p = b.word union select b.word, b.n, a.word, a.n from k a join w b on a.kind = 'less' and a.p = b.word),
 f as (select word, n, count(*) as n_near, first(other order by m desc, encode(other)) as other, max(m) as m from o group by word, n),
 g as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 5 * w.n then other end as form, case when m >= 5 * w.n then m end as form_n from w left join f on f.word = w.word),
 r(word, root) as (select word, form from g where form is not null union all select r.word, g.form from r join g on g.word = r.root where g.form is not null),
 z as (select word, root from r join w using (word) where not exists (select 1 from g where g.word = r.root and g.form is not null))
select g.word, g.n, g.n_near, g.form, g.form_n, coalesce(z.root, g.word) as root from g left join z on z.word = g.word
"""
