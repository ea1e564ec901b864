"""Changes from a client: pushed filters, landing what is missing, typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulelode.sources import changes, files

CLIENT = "fake_service:client"


def test_source_and_pushed_filters(spark, tmp_path, monkeypatch):
    df = changes.changes(spark, CLIENT)
    rows = df.collect()
    assert len(rows) == 15 and [(r.number, r.resource, r.error) for r in rows if r.error] == [(2, "reviews", "OSError: rate limited")]
    assert df.rdd.getNumPartitions() == 3 and changes.changes(spark, CLIENT, 2).rdd.getNumPartitions() == 2
    some = df.where((F.col("updated_at") >= F.lit("2025-02-01T00:00:00Z").cast("timestamp")) & (F.col("resource") == "diffs"))
    assert sorted((r.number, r.resource) for r in some.collect()) == [(2, "diffs"), (3, "diffs")]
    assert some.rdd.getNumPartitions() == 2


def test_landing_and_typed_tables(spark, tmp_path):
    folder = str(tmp_path / "d")
    tried = changes.land(spark, CLIENT, folder).collect()
    assert len(tried) == 15 and [(r.number, r.resource) for r in tried if r.error] == [(2, "reviews")]
    assert sorted(r.pr_number for r in files.pr_list(spark, f"{folder}/pr_list.json").selectExpr("number as pr_number").collect()) == [1, 2, 3]
    # Again: only what is missing is asked for.
    assert [(r.number, r.resource, r.error is not None) for r in changes.land(spark, CLIENT, folder).collect()] == [(2, "reviews", True)]
    assert not [p for p in (tmp_path / "d").rglob("*") if p.is_file() and p.name.startswith(".") and not p.name.endswith(".crc")]
    pulls = {r.pr_number: r for r in changes.pulls(spark, folder).collect()}
    assert pulls[3].title == "t3" and pulls[3].user.login == "ann" and pulls[3].additions == 3 and pulls[3].updated_at.year == 2025
    assert sorted((r.pr_number, r.id, r.state) for r in changes.reviews(spark, folder).collect()) == [(n, n * 10 + k, "APPROVED") for n in (1, 3) for k in (0, 1)]
    assert changes.issue_comments(spark, folder).count() == 6
    assert files.comments(spark, f"{folder}/review_comments").count() == 6
    got = sorted((r.path, r.old_path, r.added, r.removed, r.hunks) for r in changes.diff_files(spark, folder).where("pr_number = 1").collect() if r.old_path)
    assert got == [("gone.py", "gone.py", 0, 1, 1), ("src/a.py", "src/a.py", 3, 2, 2), ("two name.txt", "one name.txt", 0, 0, 0)]
    assert changes.diff_files(spark, folder).where("old_path is null").select("path").distinct().collect()[0][0] == "pic.png"
    assert changes.land(spark, CLIENT, folder, since="2025-03-01").count() == 0


def test_download_command(spark, tmp_path, capsys):
    from rulelode import cli

    cli.main(["--data", str(tmp_path), "--repo", "a/b", "download", "--client", CLIENT])
    text = capsys.readouterr().out
    assert "reviews: 2 fetched, 1 failed" in text and "diffs: 3 fetched" in text
