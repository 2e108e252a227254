"""Benchmark leaks against a search over all pairs, over several passes, and the latent space against a plain SVD."""

from __future__ import annotations

import numpy as np

from proofline.llm import decontaminate, latent, text


def test_latent_space(spark):
    """Gram matrices of the rows are those of a plain SVD; lower ranks lose little more than its remainder."""
    text.ship(spark)
    r = np.random.default_rng(5)
    a = np.where(r.random((60, 200)) < 0.1, r.random((60, 200)), 0.0)
    a[:, :10] += 3 * r.random((60, 1))
    entries = spark.createDataFrame([(i, int(j) - 100, float(a[i, j])) for i in range(60) for j in np.flatnonzero(a[i])], "row long, term long, weight double")
    for rank in (60, 12):
        right, rows = latent.decompose(entries, rank)
        v = {x.term + 100: np.frombuffer(x.v) for x in right.collect()}
        z = np.array([np.frombuffer(x.v) for x in rows.orderBy("row").collect()])
        m = np.array([v.get(j, np.zeros(rank)) for j in range(200)])
        assert np.allclose(m.T @ m, np.eye(rank), atol=1e-6) and np.allclose(a @ m, z, atol=1e-6)
        best = np.sqrt((np.linalg.svd(a)[1][rank:] ** 2).sum())
        assert np.linalg.norm(a - z @ m.T) <= 1.15 * best + 1e-6
    right, rows = latent.decompose(entries.where("false"), 3)
    assert right.count() == rows.count() == 0


def _corpus():
    r = np.random.default_rng(11)
    items = []
    for n, size in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 20, 31, 40, 63, 64, 65, 100, 130, 200] * 3):
        words = [f"c{k}" for k in r.integers(0, 300, size)]
        for place in range(0, size, 5):
            words[place] = f"r{n}x{place}"
        items.append((n, words))
    filler = lambda n: [f"f{k}" if k < 400 else f"c{k - 400}" for k in r.integers(0, 700, n)]
    docs, number = [], 0
    for n, words in items:
        part = words[:64] if n % 2 else words[-64:]
        docs.append((number, filler(17) + part + filler(17)))
        if len(part) >= 20:
            edited = list(part)
            for k in r.permutation([k for k in range(len(part)) if k % 5])[: len(part) // 8]:
                edited[k] = f"new{k}"
            docs.append((number + 1, filler(400) + edited + filler(3)))
        docs.append((number + 2, filler(int(r.integers(1, 150)))))
        docs.append((number + 3, part if len(part) < 3 else filler(2) + part[: len(part) // 3] + filler(20)))
        number += 4
    return items, docs


def _every_pair(items, docs):
    """(certain, possible): pairs with a passage in place, and with its words anywhere in the text's order."""
    certain, possible = set(), set()
    for i, words in items:
        last = max(0, len(words) - 64)
        for cut in {*range(0, last, 64), last}:
            passage = words[cut : cut + 64]
            size = len(passage)
            for d, own in docs:
                if size < 3:
                    if own == passage:
                        certain.add((d, i))
                        possible.add((d, i))
                    continue
                if size < 8 and any(own[s : s + size] == passage for s in range(len(own))):
                    certain.add((d, i))
                if not set(passage) & set(own) or decontaminate.lcs(passage, own) < 0.6 * size:
                    continue
                marks = {w for w in passage if w[0] == "r"}
                if not marks or marks & set(own):
                    possible.add((d, i))
                if size >= 8 and marks <= set(own) and any(sum(x == y for x, y in zip(own[s : s + size], passage, strict=False)) >= 0.8 * size for s in range(len(own))):
                    certain.add((d, i))
    return certain, possible


def test_leaks_against_every_pair(spark, monkeypatch):
    """Items of 1 to 200 words: nothing certain is lost, nothing impossible found, no pair twice over passes."""
    text.ship(spark)
    items, docs = _corpus()
    certain, possible = _every_pair(items, docs)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    found = {}
    for size in (2048, 20):
        monkeypatch.setattr(decontaminate, "PASS", size)
        got = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(rows, bench).collect()]
        assert len(got) == len(set(got))
        assert certain <= set(got) <= possible
        found[size] = set(got)
    twice = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(rows.union(rows), bench).collect()]
    assert sorted(twice) == sorted([*found[20], *found[20]])
    kept = {r.doc_id for r in decontaminate.without_leaks(rows, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found[20]}


def test_short_items_stand_as_they_are(spark):
    text.ship(spark)
    long = " ".join(f"w{k}" for k in range(40))
    docs = [(1, f"{long} Alpha beta gamma delta epsilon {long}"), (2, f"{long} alpha beta gamma x delta epsilon {long}"), (3, f"{long} yes {long}"), (4, "Yes"), (5, None), (6, "")]
    items = [(1, "alpha beta gamma delta epsilon"), (2, "yes"), (3, "w7 w8 w9"), (4, None)]
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {(1, 1), (4, 2), (1, 3), (2, 3), (3, 3)} == got


def test_paraphrases(spark):
    """Three words in ten replaced by others: most are found; other texts of the same words are not."""
    text.ship(spark)
    r = np.random.default_rng(2)
    items = [(n, [f"c{k}" for k in (400 * r.random(40) ** 2).astype(int)]) for n in range(80)]
    made, clean = [], []
    for n, words in items:
        other = list(words)
        for k in r.permutation(40)[:12]:
            other[k] = f"z{r.integers(0, 400)}"
        made.append((n, " ".join([f"z{k}" for k in r.integers(0, 400, 100)] + other + [f"z{k}" for k in r.integers(0, 400, 100)])))
        clean.append((1000 + n, " ".join(f"c{k}" for k in (400 * r.random(200) ** 2).astype(int))))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(made + clean, "doc_id long, text string"), bench)
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    assert all(d == i for d, i in got)
    print("paraphrases found", len(got), "of", len(items))
    assert len(got) >= len(items) // 3
