"""Repeats flagged on a stream against the batch rule."""

from quern.plans import text_queries
from quern.streaming.cycle import file_stream
from quern.streaming.first_seen import flag_arrivals


def test_four_deliveries_equal_the_batch_query(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    texts = ["a b", "a  b", "c", None, "d e", None]
    rows = [(i, texts[(i * 7) % 6] if i % 5 else f"own {i}") for i in range(80)]
    schema = "id bigint, text string"
    for part in range(4):
        own = rows[part * 20 : part * 20 + 20]
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(source)
        stream = file_stream(spark, source, spark.createDataFrame([], schema).schema, 1)
        flag_arrivals(stream, "id", "text", out, state).awaitTermination()  # a new run on the same state
    first = {}
    for i, text in rows:
        if text is not None:
            first.setdefault(" ".join(text.split()), i)
    want = {i: (first[" ".join(t.split())] if t is not None else i) for i, t in rows}
    got = {r["id"]: (r["first_id"], r["is_dup"]) for r in spark.read.parquet(out).collect()}
    assert got == {i: (f, f != i) for i, f in want.items()}


def test_deliveries_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    docs = spark.range(64).selectExpr(
        "id AS doc_id", "concat('text ', id % 9) AS text", "'s' AS source", "6 AS n_chars")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(text_queries, "fresh_path", lambda spark, name: str(tmp_path / name))
    got = {r["id"]: (r["first_id"], r["is_dup"]) for r in text_queries.first_occurrence_stream(spark, str(tmp_path)).collect()}
    assert got == {i: (i % 9, i >= 9) for i in range(64)}
    assert len(list((tmp_path / "arrivals" / "in").glob("*.parquet"))) > 8
