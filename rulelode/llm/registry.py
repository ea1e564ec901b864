"""Queries over the corpus tables, by name, and SQL for those which SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rulelode.llm import collocations, embeddup, langid, licenses, mixing, neardup, packing, quality, repeats, secrets, spelling, toxicity, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": repeats.op1_suffix_dedup,
        "op2_near_dedup": neardup.op2_near_dedup,
        "op3_secret_scans": secrets.op3_secret_scans,
        "op4_embedding_dedup": embeddup.op4_embedding_dedup,
        "op5_license_scans": licenses.op5_license_scans,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_mixing": mixing.op8_mixing,
        "op9_language_id": langid.op9_language_id,
        "op10_packing": packing.op10_packing,
        "op11_collocations": collocations.op11_collocations,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_url_filters": urls.op13_url_filters,
        "pipeline": corpus_pipeline.run,
    }


#: Exact links by shared shingles, and the smallest document reachable by them.
_NEAR = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
 p as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0),
 s as (select distinct doc_id, array_to_string(case when len(ws) < 5 then ws else ws[i : i + 4] end, ' ') as sh from p),
 n as (select doc_id, count(*) as n from s group by doc_id),
 c as (select a.doc_id as i, b.doc_id as j, count(*) as m from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
 e as (select i, j from c join n x on x.doc_id = i join n y on y.doc_id = j where 100 * m >= 85 * (x.n + y.n - m)),
 r(id, low) as (select doc_id, doc_id from documents union select e.j, r.low from r join e on e.i = r.id where r.low < e.j),
 g as (select id, min(low) as component_id from r group by id)
select g.id as doc_id, coalesce(n.n, 0) as n_shingles, component_id, g.id = component_id as kept from g left join n on n.doc_id = g.id
"""
_COSINE = """
with recursive v as (select vec_id, embedding::double[] as x from embeddings where embedding is not null and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(embedding, lambda y: y <> 0)) > 0),
 e as (select a.vec_id as i, b.vec_id as j from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.x, b.x) >= 0.95),
 r(id, low) as (select vec_id, vec_id from embeddings union select e.j, r.low from r join e on e.i = r.id where r.low < e.j),
 g as (select id, min(low) as component_id from r group by id), d as (select i, count(*) as n from e group by i)
select g.id as vec_id, coalesce(d.n, 0) as n_links, component_id, g.id = component_id as kept from g left join d on d.i = g.id
"""


def oracle_sql() -> dict[str, str]:
    """The others depend on fitted models, hashes of bytes or random draws; tests hold them against plain versions."""
    return {
        "op2_near_dedup": _NEAR, "op4_embedding_dedup": _COSINE, "op11_collocations": collocations.SQL, "op12_spelling_variants": spelling.SQL,
        "op13_url_filters": urls.SQL,
    }
