"""Every operator and stage on odd rows and on empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caselake.llm import chat, decontamination, jaccard, lmscore, mixing, quality, surrogates, token_counts, toxicity, vptree


def by_text(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


OVER_DOCUMENTS = {
    "op1": lambda d, labels, items: lmscore.score_documents(d, labels.filter("quality = 1").select("doc_id")),
    "op3": lambda d, labels, items: toxicity.toxicity_scores(d, toxicity.fit_chain(d, labels)),
    "op4": lambda d, labels, items: jaccard.near_duplicates(d),
    "op5": lambda d, labels, items: mixing.mix_sources(d, ["doc_id", "size", "a.b"]),
    "op6": lambda d, labels, items: surrogates.replace_entities(d, d.columns),
    "op7": lambda d, labels, items: decontamination.find_leaks(d, items, d.columns, clean=True),
    "op8": lambda d, labels, items: token_counts.count_tokens(d),
    "op9": lambda d, labels, items: quality.quality_scores(d, quality.fit_quality(d, labels), d.columns),
}


@pytest.mark.parametrize("name", list(OVER_DOCUMENTS))
def test_one_row_per_document(name, odd, labels, items):
    assert len(OVER_DOCUMENTS[name](odd, labels, items).collect()) == odd.count()


@pytest.mark.parametrize("name", list(OVER_DOCUMENTS))
def test_empty_tables(name, odd, labels, items):
    assert OVER_DOCUMENTS[name](odd.limit(0), labels.limit(0), items.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op1", "op3", "op7", "op9"])
def test_nothing_to_learn_from(name, odd, labels, items):
    assert len(OVER_DOCUMENTS[name](odd, labels.limit(0), items.limit(0)).collect()) == odd.count()


def test_defined_results(odd, labels, items):
    scores = OVER_DOCUMENTS["op1"](odd, labels, items).filter("doc_id in (0, 1, 2)").collect()
    assert {(r.n_tokens, r.score) for r in scores} == {(0, None)}
    leaks = {(r.row["doc_id"], r.row["text"]): r for r in OVER_DOCUMENTS["op7"](odd, labels, items).collect()}
    assert leaks[0, None].n_words == 0 and leaks[0, None].clean is None
    hit = [r for r in leaks.values() if r.row["doc_id"] == 5][0]
    assert (hit.n_hit, hit["items"], hit.spans) == (12, ["1", "4"], [[3, 15]])
    assert "jumps" not in hit.clean and hit.clean.startswith("the quick brown")
    clean = by_text(OVER_DOCUMENTS["op6"](odd, labels, items), "clean")
    assert clean[(None,)] == 2 and not any("x@y" in (c or "") for (c,) in clean)
    assert OVER_DOCUMENTS["op9"](odd, labels, items).filter("score < 0 or score > 1 or score is null").count() == 0


def test_one_of_each(odd):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    got = Counter(r.doc_id for r in kept.collect())
    # 3 and 4 are one text, 5 to 7 near copies; texts without words and rows without id stay
    assert got == {0: 1, 1: 2, 2: 1, 3: 1, 5: 1, 8: 1, 9: 1, None: 2}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(k, spark, odd, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    _, stage = corpus_pipeline.STAGES[k]
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns
        out.collect()


def test_chat(spark):
    kinds = "conv_id long, turn long, role string, text string, formatted string"
    data = [(1, 0, "user", None, "x"), (1, 1, "assistant", 'a & "b" <c> &lt;', "x"), (1, 1, "assistant", 'a & "b" <c> &lt;', "x"), (1, 2, None, "</turn>", "x"),
            (2, 0, "user", "no reply", None), (None, None, "assistant", "", None), (3, 5, "assistant", "z" * 200_000, None)]
    conv = spark.createDataFrame(data, kinds)
    examples = chat.expand(conv).collect()
    assert Counter(r.conv_id for r in examples) == {1: 3, 2: 1, None: 1, 3: 1}
    said = {(r.conv_id, r.example): chat_unescape(r.formatted[r.loss_start : r.loss_end]) for r in examples}
    assert said == {(1, 1): data[1][3], (1, 2): data[1][3], (1, 3): "", (2, 1): "", (None, 1): "", (3, 1): "z" * 200_000}
    read = {r.conv_id: r for r in chat.read_back(chat.expand(conv)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in read.items()} == {1: (4, 2 * len(data[1][3])), 2: (1, 0), None: (1, 0), 3: (1, 200_000)}
    assert chat.read_back(chat.expand(conv.limit(0))).collect() == []


def chat_unescape(t):
    return t.replace("&quot;", '"').replace("&lt;", "<").replace("&amp;", "&")


def test_vectors(spark):
    data = [(k, [float(k), 1.0]) for k in range(0, 2000, 10)] + [(100, None), (300, [0.0, 0.0]), (500, [1.0, None]), (700, [float("nan"), 1.0]), (None, [1.0, 1.0]), (11, [10.0, 1.0]), (11, [10.0, 1.0]), (900, [])]
    v = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    queries = v.filter("vec_id % 100 = 0")
    got = vptree.nearest_neighbours(v, queries, nearest=3, factor=1.0, shard_rows=50, block_rows=4).collect()
    of = lambda q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
    assert of(0) == [(10, 10.0), (11, 10.0), (11, 10.0)]
    assert of(100) == [(90, 10.0), (110, 10.0), (80, 20.0)]
    few = vptree.nearest_neighbours(v.filter("vec_id in (0, 10)"), queries, nearest=3).filter("query_id = 0").collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 10)]
    assert vptree.nearest_neighbours(v.limit(0), queries).collect() == []
    assert vptree.nearest_neighbours(v, queries.limit(0)).collect() == []


def test_decontamination_holds_few_words_at_a_time(monkeypatch, odd, items):
    import pyarrow as pa

    texts = ["ab " * 400, None, "", "é" * 300, "x" * 5000, "y"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["row", "t"])
    parts = list(decontamination.slices(batch, 1, 1000))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 1000 for p in parts)
    assert len(list(decontamination.slices(batch.slice(3, 6), 1, 1 << 20))) == 1
    # the texts reach the workers once, not once more among the other columns
    kept, find_leaks = [], decontamination.find_leaks
    monkeypatch.setattr(decontamination, "find_leaks", lambda docs, items, keep, **more: kept.extend(keep) or find_leaks(docs, items, keep, **more))
    cleaned = decontamination.decontaminated(odd, items)
    assert cleaned.columns == odd.columns and kept == [c for c in odd.columns if c != "text"]
    alone = decontamination.decontaminated(odd.select("text"), items)
    assert alone.columns == ["text"]
    assert sorted(str(r.text) for r in alone.collect()) == sorted(str(r.text) for r in cleaned.collect())
