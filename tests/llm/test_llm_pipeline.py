"""The corpus pipeline against its stages done by brute force."""

import corpus_pipeline
from test_llm_near_duplicates import brute_components

from hazeframe.llm import guesses, ordinal, packing, secrets
from hazeframe.llm.common import table


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]


def test_run_equals_brute_force(spark, medium):
    docs = table(spark, medium, "documents")
    kept = {r.doc_id for r in ordinal.graded(docs, ordinal.ratings_of(table(spark, medium, "labels"))).where("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    best = {}
    for doc_id, text in texts.items():
        key = (text or "").encode().lower()
        best[key] = max(doc_id, best.get(key, doc_id))
    texts = {i: texts[i] for i in best.values()}
    labels, _ = brute_components(sorted(texts.items()))
    texts = {i: texts[i] for i in texts if labels[i] == i}
    guesser = guesses.Guesser(secrets.learned_words(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    texts = {i: secrets.mask(t, guesser) for i, t in texts.items()}
    pieces = corpus_pipeline.run(spark, medium).collect()
    assert {p.doc_id for p in pieces} == set(texts) and 0 < len(texts) < docs.count()
    encoder = packing.encoder(packing.public_tokenizers.path(packing.VOCABULARY))
    tokens = {}
    for p in pieces:
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
    assert tokens == {i: len(encoder.encode(t)) + 1 for i, t in texts.items()}


def test_stages_keep_the_columns_of_documents(spark, medium):
    docs = table(spark, medium, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, medium).schema == docs.schema


def test_the_last_table_holds_the_ids(spark, tmp_path):
    texts = {1: "One text. " * 900, 2: "", 3: None, 4: "Another text, é."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    packing.pack_stage(spark, docs, "").write.parquet(f"{tmp_path}/packed")
    found = {}
    for p in sorted(spark.read.parquet(f"{tmp_path}/packed").collect(), key=lambda p: p.start):
        found[p.doc_id] = [*found.get(p.doc_id, []), *p.ids]
    encoder = packing.encoder(packing.public_tokenizers.path(packing.VOCABULARY))
    assert found == {i: [*encoder.encode(t or "").tolist(), 0] for i, t in texts.items()}


def test_op2_and_the_pipeline_give_the_same_pieces(spark, medium):
    own = packing.op2(spark, medium)
    stage = packing.pack_stage(spark, table(spark, medium, "documents"), medium)
    assert stage.columns == [*own.columns, "ids"]
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, stage.drop("ids").collect()))


def test_a_run_leaves_its_last_table_only(spark, small):
    """Checkpoints and earlier tables go as soon as the next table is written, and the result can be read again and again."""
    from pathlib import Path

    from hazeframe.session import ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    pieces = corpus_pipeline.run(spark, small)
    left = set(folder.iterdir()) - before
    assert [p.name.split("-")[0] for p in left] == ["pipeline"]
    assert [p.name for p in left.pop().iterdir()] == ["5-packing"]
    assert pieces.count() == pieces.count() > 0


def test_a_run_on_no_documents(spark, tmp_path, small):
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
