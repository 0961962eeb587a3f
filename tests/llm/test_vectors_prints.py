"""Fill-in-the-middle, SimHash components and centroid clustering against plain code."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import clustering, middle, simhash

SF = "/root/testdata/sf0.01"


def units_of(text, unit):
    return re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)


def transformed(doc_id, text, unit="line", rate=100, spm=50):
    text = text or ""
    units = units_of(text, unit)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= rate or any(s in text for s in middle.SENTINELS):
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


TEXTS = [
    "a\nb\nc\n", "é\n漢字 x\n😀y\n\n\n z", "\n", "x", "\n\n", "no <P> here\n", "<S", "<\nS>\n<M\n>", "", None, "tail <\n<S\n",
    "é" * 4000 + "\n" + "plain ascii line\n" * 4000 + "😀\r\n" * 1000, "a\rb\u2028c\nd\u0085e", "$1 \\1 \\Q \\E\n$2\n",
]


@pytest.mark.parametrize("unit, rate, spm", [("line", 100, 50), ("char", 100, 50), ("line", 40, 0), ("char", 70, 100)])
def test_fill_in_middle(llm, documents, unit, rate, spm):
    rows = [(i * 20 + j, t) for i, t in enumerate(TEXTS) for j in range(9)] + [(3, "other\ntext\n"), (None, "a\nb\n"), (None, None)]
    got = middle.fill_in_middle(documents(rows), unit=unit, rate=rate, spm=spm)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert by_text(got.select(columns).collect()) == by_text(transformed(i, t, unit, rate, spm) for i, t in rows)
    back = got.select("doc_id", middle.restored("output", "form").alias("t")).collect()
    assert by_text(back) == by_text((i, t or "") for i, t in rows)
    for r in got.filter("form <> 'plain'").collect():  # the cuts in bytes are those of the texts
        text = next(t for i, t in rows if i == r.doc_id and transformed(i, t, unit, rate, spm)[5] == r.output)
        assert len(text[: r.prefix_chars].encode()) == r.prefix_bytes
        assert len(text[r.prefix_chars : r.prefix_chars + r.middle_chars].encode()) == r.middle_bytes
    assert middle.middle_digest(middle.fill_in_middle(documents([]))).count() == 0


def test_fill_in_middle_other_sentinels(llm, documents):
    marks = ("[.*", "$1", "(|)")
    rows = [(i, "x <P>\n[.\n(|\n$\n1\n") for i in range(20)]
    got = middle.fill_in_middle(documents(rows), sentinels=marks)
    assert got.filter("form = 'plain'").count() == 0
    assert {r.t for r in got.select(middle.restored("output", "form", marks).alias("t")).collect()} == {rows[0][1]}


def plain_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, linked):
    """Least key of each point's component, over points (key, value), by a look at all pairs."""
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if linked(points[i][1], points[j][1]):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(points):
        least[find(i)] = min(key, least.get(find(i), key))
    return [least[find(i)] for i in range(len(points))]


def expected_prints(rows):
    known = [(i, plain_print(t)) for i, t in rows if i is not None]
    labels = dict(zip((i for i, _ in known), groups(known, lambda a, b: (a ^ b).bit_count() <= 3)))
    return by_text((i, f"{plain_print(t):016x}", labels.get(i)) for i, t in rows)


def test_simhash_components(llm, documents, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)] + ["É", "漢"]
    base = [[rng.choice(words) for _ in range(rng.choice([2, 3, 9, 40, 200]))] for _ in range(10)]
    rows = []
    for i in range(250):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i * 7 % 250, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(900, None), (901, ""), (902, " \x0b"), (903, "One"), (904, "one"), (905, "long " * 30_000 + "end"), (906, "\u00a0a\u2003b")]
    rows += [rows[4], rows[4], (None, rows[4][1]), (None, None)]
    got = simhash.simhash_components(documents(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = expected_prints(rows)
    assert len({r[2] for r in want}) < 240
    assert by_text(got.collect()) == want
    assert simhash.simhash_components(documents([])).count() == 0
    monkeypatch.setattr(simhash, "SLICE", 64)
    assert all(simhash.fingerprint((t or "").encode()) & (1 << 64) - 1 == plain_print(t) for _, t in rows[:60] + rows[250:257])


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_near_links_keep_components(llm, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(25)]
    for p in prints[:25] * 4:  # flips in both halves, also chains and a dense ball
        prints.append(p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, radius + 3))))
    prints += [prints[0] ^ (1 << b) for b in range(40)] + [prints[1] ^ (3 << b) for b in range(0, 64, 2)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(llm.createDataFrame([(p,) for p in signed], "fingerprint long"), radius).collect()
    assert all(a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius for a, b in links)
    assert len(set(links)) == len(links) <= 200 * len(prints)
    edges = {frozenset(x) for x in links}
    points = list(zip(signed, signed))
    assert groups(points, lambda a, b: frozenset((a, b)) in edges) == groups(
        points, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    )


def test_exploded_half_words_are_not_broadcast(llm):
    # Spark sizes a table after an explode like the one before it
    rng = random.Random(9)
    first = [rng.getrandbits(63) for _ in range(40)]
    prints = llm.createDataFrame([(p,) for p in first + [first[0] ^ 1, first[1] ^ (1 << 40)]], "fingerprint long")
    able = simhash._with_near_half(prints, 1)
    assert sorted(map(tuple, able.collect())) == sorted(
        (p, half) for pair, both in ((0, 1), (1, 1 << 40)) for p in (first[pair], first[pair] ^ both) for half in (0, 1)
    )
    plan = able._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "Broadcast" not in plan


def plain_clusters(rows, k=8, rounds=10, width=64):
    """Rows (vec_id, vector) by Python integers."""

    def usable(v):
        return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [x.as_integer_ratio()[0] * 1024 // x.as_integer_ratio()[1] for x in v], v) for i, v in rows if usable(v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v, q) for i, q, v in kept if i is not None)
    centroids = [q for _, _, q in first[:k]]

    def placed():
        out = []
        for i, q, _ in kept:
            d = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d), q))
        return out

    for _ in range(rounds):
        found = placed()
        for j in range(len(centroids)):
            mine = [q for _, c, _, q in found if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = placed()
    fits = lambda n: n if n < 1 << 63 else None
    every = fits(sum(d for *_, d, _ in out))
    total = {j: fits(sum(d for _, c, d, _ in out if c == j)) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return by_text((i, c, fits(d), total[c], every, digest[c]) for i, c, d, _ in out)


def frame(llm, rows):
    return llm.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string"
    )


@pytest.mark.parametrize("scale", [1.0, 2.0**20, 1e200])
def test_cluster_vectors(llm, scale):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 64))
    rows = [(i, (scale * (centre[i % 5] + 0.4 * rng.normal(size=64))).tolist()) for i in range(120)]
    rows += [(200 + i, (scale * 100 * rng.normal(size=64)).tolist()) for i in range(3)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 63 + [None]), (304, [math.nan] + [1.0] * 63), (305, [math.inf] * 64)]
    rows += [(306, [0.0] * 64), (307, [-5e-324] * 64), rows[0], rows[0], (0, [2.5] * 64), (None, [0.25] * 64)]
    got = clustering.cluster_vectors(frame(llm, rows)).drop("centroid")
    assert by_text(got.collect()) == plain_clusters(rows)


def test_cluster_vectors_ties_and_few_rows(llm):
    same = [(i, [float(i % 2)] * 64) for i in range(20)]
    assert by_text(clustering.cluster_vectors(frame(llm, same)).drop("centroid").collect()) == plain_clusters(same)
    assert by_text(clustering.cluster_vectors(frame(llm, same[:3])).drop("centroid").collect()) == plain_clusters(same[:3])
    small = [(i, [i / 3, -i * 1.5]) for i in range(15)]
    got = clustering.cluster_vectors(frame(llm, small), k=3, rounds=4, width=2).drop("centroid")
    assert by_text(got.collect()) == plain_clusters(small, 3, 4, 2)
    assert clustering.cluster_vectors(frame(llm, [])).count() == 0
    assert clustering.cluster_vectors(frame(llm, [(None, [1.0] * 64)])).count() == 0
    with pytest.raises(ValueError):
        clustering.cluster_vectors(frame(llm, small), width=48)


def test_progressive_search_is_exact():
    rng = np.random.default_rng(9)
    for width in (1, 2, 16, 64):
        x = rng.integers(-50, 50, (300, width))
        c = np.vstack([rng.integers(-50, 50, (6, width)), x[:1], x[:1]])
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        cluster, distance = clustering.nearest(x, c)
        assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all()
        t = clustering.transform(x)
        assert ((t**2).sum(1) == width * (x**2).sum(1)).all()
        if width == 64:  # the first four coefficients are combinations of the sums of four blocks
            blocks = x.reshape(-1, 4, 16).sum(2)
            signs = np.array([[1, 1, 1, 1], [1, 1, -1, -1], [1, -1, 1, -1], [1, -1, -1, 1]])
            assert (t[:, :4] == blocks @ signs.T).all()
