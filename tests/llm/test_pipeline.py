import random

import corpus_pipeline
from tests.llm.test_join_and_leaks import edited, groups


def rows_of(prose):
    """Repeated rows, null ids and ids that two texts share."""
    draw = random.Random(12)
    texts = prose(14, 21, words=90)
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(3, texts[3])] * 5 + [(None, texts[4])] * 4 + [(None, prose(1, 22, words=90)[0])] * 3
    near = edited(prose(1, 23, words=90)[0], 0, draw)
    rows += [(None, near), (None, edited(near, 1, draw))]  # near copies without ids
    # 9 is also the id of a near copy of document 1: one row of it goes, the other stays.
    return rows + [(9, edited(texts[1], 1, draw)), (5, prose(1, 24, words=90)[0]), (40, edited(texts[5], 1, draw))]


def brute_force(rows):
    """The smallest (id, row) of each component, null ids last."""
    kept = {}
    for place, _, root in groups(list(enumerate(t for _, t in rows))):
        key = (rows[place][0] is None, rows[place][0] or 0, place)
        kept[root] = min(kept.get(root, key), key)
    return [rows[place] for _, _, place in kept.values()]


def plain(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_one_row_of_each_group_stays(spark, make, prose):
    rows = rows_of(prose)
    got = corpus_pipeline.near_duplicate_join(spark, make(rows), "").select("doc_id", "text").collect()
    assert plain(map(tuple, got)) == plain(brute_force(rows))


def test_run_packs_one_row_of_each_group(spark, make, prose, tmp_path):
    rows = rows_of(prose)
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    leak = " ".join(rows[7][1].split()[20:50])
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    ids = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    kept = brute_force(rows)
    assert ids == {k for k, t in kept if leak.lower() not in " ".join(t.lower().split())} and 7 not in ids


def test_run_takes_odd_rows_and_clashing_columns(spark, make, odd, prose, tmp_path):
    rows = [*odd, *enumerate(prose(6, 30), 20), (None, prose(1, 31)[0] + " mail bob@example.com")]
    docs = make(rows).selectExpr("*", "1 AS _t", "2 AS row", "3 AS place", "4 AS kept", "5 AS _h")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_t", "row", "place", "kept", "_h"], name
    assert any("[EMAIL]" in r.text for r in docs.collect() if r.doc_id is None)
    # What is too short or repeats itself goes, the rest stays.
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {None, *range(20, 26)}


def test_run_on_empty_tables(spark, make, tmp_path):
    make({}).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_blank_texts_stay_apart(spark, make):
    rows = [(1, None), (1, None), (2, ""), (3, " \n"), (3, " \n"), (4, "a b c d e"), (4, "a b c d e"), (5, "a b c d e")]
    got = corpus_pipeline.near_duplicate_join(spark, make(rows), "").select("doc_id", "text").collect()
    assert plain(map(tuple, [(r.doc_id, r.text or "") for r in got])) == plain((k, t or "") for k, t in rows[:6])
