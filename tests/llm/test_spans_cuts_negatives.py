"""Personal data, hard negatives and fill-in-the-middle against brute force, with odd rows."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofline.llm import fill_in_middle, hard_negatives, pii, queries, text
from tests.compare import connect, difference

ODD = [
    None, "", " ", "\n \n b", "a  b ", "x<P>y z", "one", " lead and trail \t", "　 wide 　 space", "日本語 😀 é́ text", "\x00a\x00 b",
    "no @ mail a@b c@d.e. x@y..z q.w@e.r+t@u.v", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3 1.2.3", "4111 1111 1111 1111 x 4111-1111-1111-1112",
    "+1 (234) 567-8901 and +12 and +1234567890123456789", "+1 (826) 555-4081 190.137.223.204", "4111111111111111 4111111111111111", "a@1.2.3.4 é@b.c", "+++1(2)3 4 5 6 7 8 9.",
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    """The documents, odd texts, one of several MB, a repeated row, a null id and clashing columns."""
    text.ship(spark)
    base = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    long = "".join(f"w{k} +1 (826) 555-{k % 10000:04d}\n" if k % 997 == 0 else f"wörd{k}  " for k in range(250_000))
    rows = [(1_000_000 + i, t) for i, t in enumerate(ODD)] + [(1_000_003, ODD[3]), (None, "null id m@n.org"), (1_000_500, long)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    clash = {"n": F.lit(1), "form": F.lit("x"), "output": F.lit(2), "spans": F.lit(0), "_key": F.lit("k"), "row": F.lit("r")}
    return base.union(extra).withColumns(clash).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def brute_pii(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            digits = [int(c) for c in m.group() if c.isdigit()]
            summed = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
            if least <= len(digits) <= most and (kind == 3 or summed % 10 == 0):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@pytest.fixture(scope="module")
def model(docs):
    return pii.fit(docs)


def test_pii_base(docs, rows, model):
    got = pii.find_pii(docs, model).collect()
    want = collections.Counter()
    for i, t in rows:
        base = brute_pii(t)
        want[i, *(sum(k == kind for _, k, _ in base) for kind in range(4)), hashlib.sha256(pii.written(base).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        spans = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0]), int(s.split(":")[2])) for s in r.spans.split(",") if s]
        assert spans == sorted(set(spans)) and any(set(brute_pii(t)) <= set(spans) for t in texts[r.doc_id])
    by = {r.doc_id: r.spans for r in got}
    assert by[1_000_015] == "phone:0:17,ip:18:33"  # the plain phone pattern swallows the address and drops both
    assert by[1_000_016] == "card:0:16,card:17:33" and by[None] == "email:8:15"
    assert pii.find_pii(docs.where("false"), model).count() == 0 and pii.fit(docs.where("false")) is None
    assert pii.find_pii(docs, None).where("doc_id = 1000015").first().spans == "ip:18:33"


def test_pii_takes_the_best_segmentation(model):
    """The dynamic programme against all segmentations of short stretches."""
    for t in ("+1 (826) 555-4081 1.2.3.4", "4111111111111111 4111111111111111", "a@b.cd 123-456-7890", "1.2.3.4 5.6.7.8"):
        cuts, base = pii.units(t, 0, len(t)), []
        every = collections.defaultdict(list)
        for i, j, kind in pii.segments(t, cuts, base):
            names = pii.outside(t[cuts[i] : cuts[j]]) if kind < 0 else pii.features(kind, t, cuts[i], cuts[j])
            every[i].append((j, kind, sum(model["weights"].get(f, 0.0) for f in names)))

        def walk(at, before, cuts=cuts, every=every):
            if at == len(cuts) - 1:
                return 0.0, []
            options = []
            for j, kind, score in every[at]:
                rest, path = walk(j, kind)
                options.append((score + model["moves"][before][kind] + rest, [(cuts[at], kind, cuts[j])] * (kind >= 0) + path))
            return max(options)

        assert pii.best_segments(t, cuts, base, model["weights"], model["moves"]) == walk(0, -1)[1]


def test_pii_expected_counts():
    """Expected counts of segments against sums over all segmentations."""
    r = np.random.default_rng(1)
    cells = [(0, e, d, k) for e in range(1, 5) for d in range(1, e + 1) for k in range(5) if d == 1 or k < 4]
    score, moves = r.normal(size=len(cells)), r.normal(size=(5, 5))
    expect, moved = pii._expected(score, np.array(cells), np.array([0]), 4, moves)
    value, want, total = {c[1:]: s for c, s in zip(cells, score, strict=True)}, collections.Counter(), 0.0

    def walk(at, before, path, weight):
        nonlocal total
        if at == 4:
            total += np.exp(weight)
            for step in path:
                want[step] += np.exp(weight)
            return
        for (e, d, k), s in value.items():
            if e - d == at:
                walk(e, k, [*path, (e, d, k)], weight + s + moves[before, k])

    walk(0, 4, [], 0.0)
    assert np.allclose(expect, [want[c[1:]] / total for c in cells]) and np.isclose(moved.sum(), expect.sum())


def test_pii_finds_other_spellings(model):
    for t, kind in (("call (415) 555-0199 now", "phone"), ("to jo.doe (at) mail (dot) example.com please", "email"), ("von 4111.1111.1111.1111 bezahlt", "card")):
        assert kind in pii.written(pii.find_spans(t, model)[1]), t
    for t in ("version 12.0.33 of 2024-01-15", "isbn 9783161484100 or 12345678901", "look at foo.bar", "((((((", "0123456789abcdef0123456789abcdef"):
        assert pii.find_spans(t, model)[1] == [], t


def test_without_pii(docs, model):
    clean = pii.without_pii(docs, model)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    got = {r.doc_id: r.text for r in clean.where("doc_id >= 1000000").collect()}
    assert got[1_000_000] is None and got[1_000_015] == "[phone] [ip]"


def test_hard_negatives(spark, sf):
    text.ship(spark)
    base = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    odd = [
        (5000, None, 1), (5001, [float("nan")] * 64, 1), (5002, [None] * 64, 2), (None, base[0][1], 3), (5003, [1.0], 1), (5100, [], 1), (5200, base[3][1], None), (base[100][0], base[100][1], base[100][2]),
        *[(6000 + k, base[5][1], 4) for k in range(12)], *[(6100 + k, base[5][1], 5) for k in range(12)], (7000, [-x for x in base[7][1]], 6), (7100, [1e6] * 64, 6), (7101, [9e5] * 64, 7), (7102, [1e6] * 64, 6),
    ]
    rows = base + odd
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"rank": F.lit(9), "place": F.lit(1), "block": F.lit(0)})
    good = [(i, [int(np.floor(256 * x)) for x in v], k) for i, v, k in rows if i is not None and k is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    want = collections.Counter()
    for a, v, k in {(i, tuple(v), k) for i, v, k in good if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m) for i, w, m in good if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == k][:5]:
            window = [(n, i) for n, i, m in scored if m != k and 80 * -s <= 100 * -n <= 100 * -s]
            want.update((a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(window[:5]))
    assert collections.Counter(map(tuple, hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0).collect())) == want and len(want) > 10
    assert hard_negatives.mine(vectors.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.scores(np.full((1, 4), 1e12), np.full((1, 4), 1e12))


@pytest.mark.parametrize(("d", "size"), [(1, 1), (64, 200), (300, 5000), (7, 1 << 28), (3, 2**30)])
def test_residue_products_are_exact(d, size):
    r = np.random.default_rng(d)
    a, b = (r.integers(-size, size + 1, (n, d)) for n in (9, 13))
    want = a.astype(object) @ b.T.astype(object)
    assert (hard_negatives.scores(a.astype(float), b.astype(float)).astype(object) == want).all()


def test_blocks_of_anchors(spark, sf, monkeypatch):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    whole = sorted(map(tuple, hard_negatives.mine(vectors, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    assert sorted(map(tuple, hard_negatives.mine(vectors, F.col("vec_id") % 20 == 0).collect())) == whole


def brute_middle(i, t):
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[a:z]) for a, z in ((0, x), (x, y), (y, n)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return i, n, "plain", None, None, t
    form = "spm" if h4 % 100 < 80 else "psm"
    return i, n, form, len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(docs, rows):
    got = fill_in_middle.rearrange(docs).withColumn("again", fill_in_middle.restored()).collect()
    assert collections.Counter(tuple(r)[:6] for r in got) == collections.Counter(brute_middle(i, t) for i, t in rows)
    assert collections.Counter((r.doc_id, r.again) for r in got) == collections.Counter(rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"} and fill_in_middle.rearrange(docs.where("false")).count() == 0


@pytest.mark.parametrize("error", [0, 5, 63, 126])
def test_rank_index(error):
    r = np.random.default_rng(error)
    for offsets in (np.array([0]), np.cumsum(r.integers(1, 9, 30_000)), np.cumsum(np.where(r.random(5000) < 0.01, 50_000, 3)), np.arange(5000) * 7):
        index = fill_in_middle.RankIndex(offsets, error)
        assert (index.offsets(np.arange(len(offsets))) == offsets).all()
        assert np.abs(index.residual.astype(int)).max() <= error + 1
    assert len(index.first) == 1  # equal steps are one segment


def test_registered_match_their_sql(spark, sf):
    con = connect(sf)
    for name in ("op12_hard_negatives", "op13_fill_in_middle"):
        assert difference(queries.registered()[name](spark, sf), con, queries.sql()[name]) is None, name


def test_registered_pii(spark, sf):
    got = {r.doc_id: r for r in queries.op11_pii(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].base_sha256 == hashlib.sha256(pii.written(brute_pii(r.text or "")).encode()).hexdigest()
