"""The pipeline on a small corpus: each stage against what its operator says of the stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import components, contamination, prose


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    clean = [(i, ". ".join(prose(14, 5000 + 9 * i + k, 3000).capitalize() for k in range(8))) for i in range(300)]
    junk = [(400 + i, " ".join(f"W{k}%%%" for k in range(i, i + 80))) for i in range(80)]
    item = prose(40, 77, 3000)
    rows = clean + junk + [(500, clean[3][1]), (501, clean[4][1].replace("W1", "x", 1)), (600, f"{item} {item}"), (601, clean[7][1] + " token=abcdefghijklmnop"), (602, None), (None, "Plain words without an id. " * 3)]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {i: t for i, t in rows}, item


def test_stages(spark, corpus):
    path, texts, item = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.settle(stage(spark, docs, path), f"stage-{k}")
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        kept.append({r[0]: r for r in docs.collect()})
    quality, dedup, clean, redacted, encoded = kept
    assert not {i for i in quality if i is not None and 400 <= i < 480} and {i for i in quality if i is not None and i < 300} == set(range(300))
    groups = components([(i, texts[i]) for i in quality if i is not None])
    assert set(dedup) - {None} == {i for i, c in groups.items() if i == c}
    hit = {i: contamination(texts[i], [(1, item)]) for i in dedup}
    assert set(clean) == {i for i, (n, h, _) in hit.items() if not (h and 20 * h >= n)}
    assert 600 not in clean and 500 not in dedup
    for i, r in redacted.items():
        assert ("token=abc" not in (r.text or "")) and (r.text == texts[i] or (i == 601 and r.n_chars == len(r.text)))
    assert set(encoded) == set(redacted) and (None in quality) == (None in encoded)


def test_run_equals_its_stages(spark, corpus):
    path, _, _ = corpus
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert out.filter(F.col("doc_id") == 5).count() == 1


@pytest.mark.parametrize("empty", [False, True])
def test_repeated_ids_clashing_names_and_empty_tables(spark, tmp_path, empty):
    clean = [(i, ". ".join(prose(14, 9000 + 9 * i + k, 3000).capitalize() for k in range(8))) for i in range(60)]
    junk = [(100 + i, " ".join(f"W{k}%%%" for k in range(i, i + 80))) for i in range(30)]
    # 3 and 7 share a text through 50, whose own rows are unlike; 5 comes twice and is equal.
    rows = [*clean, *junk, (50, clean[3][1]), (50, clean[7][1]), clean[5], (None, clean[9][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(1) for c in ("score", "id", "spans", "kept", "component", "n_words", "N_HIT", "ids")})
    (docs.limit(0) if empty else docs).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int")
    (labels.limit(0) if empty else labels).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    if empty:
        assert got == []
        return
    # 50 links 3 and 7, so that 3 alone stays of the three ids; both rows of 5 stay; the row without an id stays.
    want = [i for i, _ in clean if i not in (7, 50)] + [5]
    assert got == sorted([*((False, i) for i in want), (True, 0)])
