"""Near-duplicates by Jaccard similarity, against brute force."""

import numpy as np

import corpus_pipeline
from tallyspark.llm import neardup, simhash


def brute_set(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute_components(texts):
    sets, root = [brute_set(t) for t in texts], list(range(len(texts)))
    similar = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for i, j in similar * len(texts):
        root[i] = root[j] = min(root[i], root[j])
        if all(root[a] == root[b] for a, b in similar):
            break
    return root, similar


def planted(seed=11):
    """Unlike texts, and copies of them from which words at the start or in the middle are replaced."""
    rng = np.random.default_rng(seed)
    word = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    texts = [" ".join(word(int(n))) for n in rng.integers(60, 400, 40)]
    for t in texts[:30]:
        w = t.split()
        for share in (0.03, 0.06, 0.09, 0.13):
            n, at = max(1, int(share * len(w))), int(rng.integers(0, len(w) // 2))
            texts.append(" ".join(w[:at] + word(n) + w[at + n :]).upper())
    return [*texts, "", "  ", "two words", "Two Words", texts[0]]


def test_pipeline_stage_finds_similarity_of_080(spark):
    texts = planted()
    root, similar = brute_components(texts)
    assert len(similar) > 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_large_buckets_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "_SLICE", 16)
    rng = np.random.default_rng(12)
    base = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(120)]
    texts = []
    for _ in range(60):  # variants of one text, mostly less than 0.8 alike, some more
        w = list(base)
        for at in rng.integers(0, 120, 3):
            w[at] = str(rng.integers(0, 4))
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(60)] == brute_components(texts)[0]


def test_rows_are_told_apart_by_text(spark):
    """Rows without an id, and different texts under one id, are judged by their texts; one row of each group stays."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "one text of its own"), (None, "another text that is unlike it"), (None, "another text that is unlike it"), (None, None), (1, "a third"), (1, "a third"), (2, "a third"), (5, long), (5, "other words under this id"), (None, long + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.drop_near_duplicates(docs, similar=0.8)
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [rows[k] for k in (0, 1, 3, 4, 7, 8)]))
    assert kept.columns == docs.columns and simhash.drop_near_duplicates(docs.limit(0), similar=0.8).count() == 0


def test_trees_alone_miss_what_the_bands_find(spark):
    """At similarities of 0.8 and more most pairs lie more than three bits apart: both kinds of candidates are needed."""
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    alone, both = simhash.drop_near_duplicates(docs).count(), simhash.drop_near_duplicates(docs, similar=0.8).count()
    assert both == len(set(brute_components(texts)[0])) < alone
