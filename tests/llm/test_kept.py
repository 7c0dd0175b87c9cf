"""What is kept between runs, and what must not change when it is computed again."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantferry.llm import common, lattice, queries, token_trees, toxicity

LOG = "doc_id long, seq int, pos long, deleted long, inserted string"
TEXTS = [None, "", "one", "It's 3 o'clock,  and we'll see… " * 60, "é語😀 ñ " * 40, "x" * 5000, "a b\n\nc " * 700]


def change(text, e):
    """An edit on a plain text."""
    pos = min(max(e[2], 0), len(text))
    return text[:pos] + (e[4] or "") + text[pos + max(e[3] or 0, 0):]


def test_trees_are_kept_over_two_tables_of_edits(spark, tmp_path):
    r = random.Random(5)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(3, "again", 1), (None, "no id", 1)], "doc_id long, text string, lens int")
    texts = {(i, n): t or "" for n, (i, t) in enumerate([*enumerate(TEXTS), (3, "again"), (None, "no id")])}
    counter = token_trees.Counter(queries.RANKS, queries.PRE_TOKENS)
    kept = token_trees.keep(token_trees.trees(docs, queries.RANKS, queries.PRE_TOKENS), str(tmp_path / "0"))
    for step in (1, 2):
        log = [(i, s, r.randrange(-2, len(TEXTS[i] or "") + 3), r.choice([None, 0, 3, 40]), r.choice([None, "", " don't", "\n 12ab", "ñ"])) for i in (0, 1, 3, 4, 6) for s in range(4)]
        edits = spark.createDataFrame([*log, (None, 0, 0, 2, "lost"), (99, 0, 0, 2, "nobody"), (2, 0, None, 1, "nowhere")], LOG)
        kept = token_trees.keep(token_trees.after(kept, edits, queries.RANKS, queries.PRE_TOKENS), str(tmp_path / str(step)))
        for e in log:
            texts = {k: change(t, e) if k[0] == e[0] else t for k, t in texts.items()}
        got = kept.collect()
        assert sorted((x["doc_id"] is None, x["doc_id"], x["text"]) for x in got) == sorted((k[0] is None, k[0], t) for k, t in texts.items())
        for x in got:
            words = counter.pattern.findall(x["text"])
            assert token_trees.unpacked(x["lens"]) == [len(w) for w in words] and token_trees.unpacked(x["counts"]) == [len(counter.encode(w)) for w in words]
            if x["doc_id"] in (None, 2, 5):
                assert x["n_encoded_anew"] == 0  # never edited
            if x["doc_id"] == 6:
                assert 0 < x["n_encoded_anew"] < len(words) / 10
    none = token_trees.after(kept.limit(0), edits, queries.RANKS, queries.PRE_TOKENS)
    assert none.count() == 0
    assert token_trees.after(kept, edits.limit(0), queries.RANKS, queries.PRE_TOKENS).agg(F.sum("n_encoded_anew")).first()[0] == 0


def test_edits_encode_only_what_they_touch(spark):
    text = "The quick brown fox jumps over the lazy dog. " * 2000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = token_trees.counts(docs, queries.sample_edits(), queries.RANKS, queries.PRE_TOKENS).first()
    assert got["n_pretokens"] > 20_000 and got["n_encoded_anew"] < 40 and got["n_edits"] == 3


def test_rows_are_settled_before_they_are_numbered(spark, tmp_path):
    spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("unit"), "id", F.lit("word")).alias("text")).write.parquet(str(tmp_path / "d"))
    files = spark.read.parquet(str(tmp_path / "d"))
    assert common.settled(files.filter("doc_id > 3").select("text")).inputFiles() == files.inputFiles()
    assert common.settled(files.repartition(3)).inputFiles() != files.inputFiles()
    assert common.settled(files.withColumn("r", F.rand())).inputFiles() != files.inputFiles()
    # an order that is another each time it is computed
    shuffled = files.withColumn("z", F.expr("rand()")).repartition(5, "z").sortWithinPartitions("z")
    v = lattice.load(queries.PIECES)
    for x in lattice.encoded(shuffled, v).withColumn("back", lattice.decoded(F.col("ids"), v)).collect():
        assert x["back"] == f"unit {x['doc_id']} word"


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = [(i, " ".join(r.choices(words, k=60)) + (" utter scum" if i % 2 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows + [(7, "another text of the same id"), (8, "z" * 30_000)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")


def fitted_on(monkeypatch, docs, labels, **kw):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.append((texts, toxic)))
    toxicity.train(docs, labels, **kw)
    return seen[0]


def test_toxicity_fit_is_bounded_by_characters(monkeypatch, labelled):
    docs, labels = labelled
    texts, toxic = fitted_on(monkeypatch, docs, labels)
    assert len(texts) == 120 and sum(toxic) == 60
    small, classes = fitted_on(monkeypatch, docs, labels, max_total=8000)
    for c in (0, 1):
        total = sum(len(t) for t, y in zip(small, classes) if y == c)
        assert 3500 < total <= 4000
    assert set(small) < set(texts)
    assert fitted_on(monkeypatch, docs, labels, max_total=0)[0] == []


def test_toxicity_takes_the_same_text_of_a_repeated_id(monkeypatch, labelled):
    docs, labels = labelled
    runs = [fitted_on(monkeypatch, docs.repartition(n), labels) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2]


def test_toxicity_scores_by_brute_force(spark, labelled):
    """Each score is the sum of the parts of a text's distinct n-grams, hashed one by one."""
    docs, labels = labelled
    model = toxicity.train(docs, labels)

    def hashed(gram):
        h, mask = 0, 0xFFFFFFFF
        for i, c in enumerate(gram):
            h = (ord(c) * 0x9E3779B1) & mask if i == 0 else (((h ^ (h >> 15)) * 0x85EBCA6B) + ord(c) * 0x9E3779B1) & mask
        return ((h * 0xC2B2AE35) & mask) >> (32 - toxicity.BITS)

    got = {(x["doc_id"], x["n"]): x["score"] for x in toxicity.score_documents(docs, model).join(docs.select("doc_id", F.length("text").alias("n")), "doc_id").collect()}
    for x in docs.filter("doc_id < 6").collect():
        padded = f" {' '.join(x['text'].lower().split())} "
        found = {hashed(padded[i:i + n]) for n in toxicity.SIZES for i in range(len(padded) - n + 1)}
        z = sum(float(model.part[h]) for h in found) + model.bias
        assert got[x["doc_id"], len(x["text"])] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
