import corpus_pipeline
from cabline.llm import hamming, quality, queries
from cabline.llm._common import cut
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import near_duplicates


def test_stages_and_run(spark, small):
    """The stages one by one, each against its own input."""
    docs = small("documents")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(cut(stage(spark, seen[-1], SF_SMALL), f"test-{name}"))
    assert all(x.columns == columns for x in seen[:-1])
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    quality = {r.doc_id for r in queries.op3_quality_rules(spark, SF_SMALL).where("kept").collect()}
    assert ids[1] == quality
    assert ids[2] == {r.doc_id for r in hamming.near_duplicates(seen[1]).where("kept").collect()}
    assert ids[3] <= ids[2] and ids[4] == ids[3] == ids[5]
    run = corpus_pipeline.run(spark, SF_SMALL)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(key).collect())) == sorted(
        map(tuple, seen[-1].select(key).collect()))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontaminate", "replace_pii", "pack"]


def test_stages_on_odd_and_empty(spark, small):
    empty = small("documents").limit(0)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
         (3, "some words", None, None, None), (3, "some words", None, None, None)],
        small("documents").schema)
    for docs in (empty, odd):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF_SMALL).columns == docs.columns
            assert stage(spark, docs, SF_SMALL).count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()


def test_near_duplicates_from_four_fifths_on(spark, small):
    """Copies whose similarity is 0.80 to 0.85, and one under it, against brute force."""
    texts = {}
    for i in range(80):
        words = [f"t{i}_{j}" for j in range(150)]
        texts[2 * i] = " ".join(words)
        for at in ((20, 70, 120) if i % 4 else (20, 50, 80, 110)):      # 0.81, 0.76
            words[at] = f"edit{at}"
        texts[2 * i + 1] = " ".join(words)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in texts.items()],
                                 small("documents").schema).repartition(3)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()}
    assert got == {d for d, (_, _, kept) in near_duplicates(texts, 80).items() if kept}
    assert len(got) == 100


def test_rows_without_an_id_and_repeated_rows(spark, small):
    """Each row is judged by its own text, and one row of a group of copies stays."""
    schema = small("documents").schema
    item = next(r.text for r in small("benchmark").collect() if len((r.text or "").split()) > 15)
    texts = [" ".join(f"u{i}_{j}" for j in range(60)) for i in range(5)]
    rows = [(None, item), (None, texts[0]), (7, item), (7, texts[1])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], schema)
    out = corpus_pipeline.decontaminate(spark, docs, SF_SMALL)
    assert sorted(r.text for r in out.collect()) == sorted(texts[:2])
    rows = [(None, texts[0]), (None, texts[0]), (3, texts[0]), (None, texts[1]), (None, texts[1]),
            (4, texts[2]), (4, texts[2]), (4, texts[3]), (6, texts[4]), (5, texts[4]),
            (None, None), (8, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                 schema).repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(3, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (5, texts[4]),
         (None, None), (8, "")], key=str)


def test_tables_of_whole_rows_are_compressed_well(spark, small, monkeypatch):
    """Those that stay on disk until a stage is written; their Python batches are small."""
    files, batches = {}, {}

    def seen(df, name, *rest):
        batches[name] = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        out = cut(df, name, *rest)
        files[name] = out.inputFiles()
        return out

    for module in (corpus_pipeline, quality):
        monkeypatch.setattr(module, "cut", seen)
    docs = small("documents").limit(60)
    corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    for name in ("quality-scores", "numbered-rows"):
        assert files[name] and all(x.endswith(".zstd.parquet") for x in files[name])
    assert int(batches["quality-scores"]) == 1000
