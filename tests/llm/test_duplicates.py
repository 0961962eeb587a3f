"""Jaccard join, components, decontamination and the pipeline against brute force."""

import random
import time
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from tidemark.llm import bitmap, decontam, graph, jaccard, packing, secret_scan, shingles
from tidemark.llm.graph import components
from tidemark.session import CLEANUP, durable

SF = "/root/testdata/sf0.001"
VOCABULARY = packing.default_vocabulary()


def groups(rows, percent=80):
    sets = [shingles.shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.3:
            text += rng.choice(base)[: rng.randrange(10)]
        rows.append((i * 7 % n, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [300, 100_000])
def test_jaccard_join(llm, documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(5, 300) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "W0  W1"), (1004, "w0 w1"), (1005, "long " * 50_000)]
    rows += [(5, rows[5][1]), rows[9], rows[9]]
    got = jaccard.jaccard_components(documents(rows)).collect()
    assert sorted(map(tuple, got)) == groups(rows)


def plain_links(rows, percent=80):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None and (s := frozenset(shingles.shingle_set(text))):
            sets.setdefault(s, []).append(doc_id)
    names = [(min(ids), s, len(ids)) for s, ids in sets.items()]
    links = {
        (min(a, b), max(a, b)) for i, (a, s, _) in enumerate(names) for b, t, _ in names[:i]
        if 100 * len(s & t) >= percent * len(s | t)
    }
    copies = {a: n for a, _, n in names}
    count = {a: n - 1 + sum(copies[y if x == a else x] for x, y in links if a in (x, y)) for a, n in copies.items()}
    name_of = {i: min(ids) for ids in sets.values() for i in ids}
    return links, sorted((i, name_of.get(i, i), count.get(name_of.get(i), 0)) for i, _ in rows if i is not None)


@pytest.mark.parametrize("block", [300, 100_000])
def test_jaccard_links(llm, documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(6, 220) + [(1000, None), (1001, " "), (1002, "w0 w1"), (1003, "W0 w1")]
    rows += [rows[3], rows[3], (2000, rows[4][1])]
    links, counts = jaccard.jaccard_links(documents(rows + [(None, rows[4][1])]))
    want, per_row = plain_links(rows)
    got = [tuple(r) for r in links.collect()]
    assert set(got) == want and len(got) == len(want) > 50
    counts = [tuple(r) for r in counts.collect()]
    assert (None, None, 0) in counts and sorted(c for c in counts if c[0] is not None) == per_row


def test_many_copies_take_linear_work(llm, documents):
    """One cluster of thousands of near copies that all meet its pivot: no pair of them is looked at."""
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[: i % 290], f"x{i}", *base[i % 290 + 1 :]])) for i in range(3000)]
    seen = []
    real = jaccard._able_to_link

    def watched(members, described, percent):
        seen.append(members.count())
        return real(members, described, percent)

    jaccard._able_to_link = watched
    try:
        got = jaccard.jaccard_components(documents(rows)).select("component_id").distinct().collect()
    finally:
        jaccard._able_to_link = real
    assert [r.component_id for r in got] == [0] and seen == [0]


def test_sets_and_signatures_move_to_their_pivots_only(llm, documents, monkeypatch):
    """Beside a repeated row's one copy (once for each side) nothing wide is shuffled but by its pivot."""
    plans, real = {}, jaccard.durable

    def watched(df, name="stage"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(jaccard, "durable", watched)
    before = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = near_copies(8, 60)
        got = jaccard.jaccard_components(documents(rows)).collect()
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, got)) == groups(rows)
    for name in ("bounds", "near"):
        assert plans[name].count("Exchange hashpartitioning(pivot") == 2, name
        assert plans[name].count("Exchange hashpartitioning(") == 4, name


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_shared_cells(llm, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_CELLS", chunk)
    rng = random.Random(3)
    cells = [rng.randrange(-(2**63), 2**63) for _ in range(400)] + [0, -1, -(2**63), 2**63 - 1]
    rows = [[77, *rng.sample(cells, rng.randrange(5))] for _ in range(150)]
    table = llm.createDataFrame([(row,) for row in rows] + [([],)], "prefix array<long>").repartition(3)
    seen = Counter(c % 2**64 >> 64 - jaccard.KEY_BITS for row in rows for c in row)
    got = jaccard._shared_cells(table, sum(map(len, rows)))
    assert sorted(r.key for r in got.collect()) == sorted(c for c, n in seen.items() if n > 1)
    assert jaccard._shared_cells(table.limit(0), 0).count() == 0
    keyed = llm.createDataFrame([(c,) for c in cells], "cell long").select("cell", jaccard._cell_key("cell").alias("key"))
    assert all(r.key == r.cell % 2**64 >> 64 - jaccard.KEY_BITS for r in keyed.collect())


def test_map_grows_with_its_keys(llm):
    assert bitmap.bits_for(0) == bitmap.bits_for(8_000_000) == bitmap.BITS
    assert bitmap.bits_for(9_000_000) == 2 * bitmap.BITS and bitmap.bits_for(10**10) == bitmap.MOST_BITS
    keys = llm.range(1000).withColumn("at", bitmap.place("id", 4 * bitmap.BITS))
    table = bitmap.build(keys, "id", 4 * bitmap.BITS)
    assert bitmap.holds(table, keys.toPandas()["at"].to_numpy()).all() and len(table) == bitmap.BITS // 2


def test_staged_tables_keep_no_shuffles(llm):
    def files():
        folders = llm._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in folders for f in Path(str(d)).rglob("shuffle_*")}

    before, setting = files(), llm.conf.get(CLEANUP, None)
    table = durable(llm.range(1000).repartition(3, "id"))
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not files() - before and table.count() == 1000
    assert llm.conf.get(CLEANUP, None) == setting


def test_jaccard_null_ids_and_empty_table(llm, documents):
    text = "a b c d e f g h"
    got = jaccard.jaccard_components(documents([(None, text), (3, text), (4, "x")])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(None, None), (3, 3), (4, 4)}
    assert jaccard.jaccard_components(documents([])).count() == 0


def test_keep_one(llm, documents):
    rows = near_copies(6, 120) + [(0, "other text of the same id and more words")]
    docs = documents([*rows, rows[3], (None, "x"), (None, "x")])
    found = jaccard.jaccard_components(docs)
    out = jaccard.keep_one(docs, found)
    assert out.columns == docs.columns
    least = {doc_id for doc_id, _, component in groups(rows) if doc_id == component}
    want = {(doc_id, text) for doc_id, text in rows if doc_id in least}
    assert sorted((r.doc_id, r.text) for r in out.filter("doc_id IS NOT NULL").collect()) == sorted(want)
    assert out.filter("doc_id IS NULL").count() == 2


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(5, 3), (3, 5), (9, 8), (8, 7), (100, 5), (7, 7)],
])
def test_components(llm, edges):
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = components(llm.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in parent)


def test_components_take_no_more_rounds_than_the_links_need(llm, monkeypatch):
    """Stars are their own answer; each round writes two tables, and none is written only to see that nothing changes."""
    written, real = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df, name="stage": written.append(name) or real(df, name))
    stars = [(i % 3, i) for i in range(3, 400)]
    got = components(llm.createDataFrame(stars, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(i, i % 3) for i in range(400)} and len(got) == 400
    assert len(written) == 1
    written.clear()
    got = components(llm.createDataFrame([*stars, (5, 400), (400, 401)], "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(i, 2 if i > 399 else i % 3) for i in range(402)}
    assert len(written) <= 5


def test_small_staged_tables_are_few_files(llm, documents, monkeypatch):
    """However many shuffle partitions there are, a table of a few rows isn't written as a file for each."""
    files, real = {}, jaccard.durable

    def watched(df, name="stage"):
        out = real(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard, "durable", watched)
    before = {k: llm.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for key, value in zip(before, ("20", "false")):
        llm.conf.set(key, value)
    try:
        rows = near_copies(9, 60)
        got = sorted(map(tuple, jaccard.jaccard_components(documents(rows)).collect()))
    finally:
        for key, value in before.items():
            llm.conf.set(key, value)
    assert got == groups(rows)
    cores = llm.sparkContext.defaultParallelism
    for name in ("reps", "ends", "wanted", "labels", "kinds", "left", "members", "blocks", "able", "components"):
        assert files[name] <= 2 * cores, name


@pytest.mark.parametrize("share", [0.001, 1.0])
def test_components_with_hot_nodes(llm, monkeypatch, share):
    """Binary nodes, some with hundreds of neighbours, whose rows are looked up or meet in one place."""
    monkeypatch.setattr(graph, "HOT_SHARE", share)
    rng = random.Random(11)
    links = {(rng.choice([70, 300, 555]), rng.randrange(600)) for _ in range(700)} | {(rng.randrange(600, 900), rng.randrange(600, 900)) for _ in range(200)}
    parent = list(range(900))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in links:
        x, y = sorted((find(x), find(y)))
        parent[y] = x
    name = lambda x: x.to_bytes(4, "big")
    got = components(llm.createDataFrame([(bytearray(name(x)), bytearray(name(y))) for x, y in links], "a binary, b binary")).collect()
    assert sorted((bytes(r.node), bytes(r.label)) for r in got) == sorted((name(x), name(find(x))) for x in {z for link in links for z in link})


def test_shingle_hashes_follow_the_words():
    texts = ["a b c d e f", "A b\tC d E", "x", "", "one two", " é É a b c", "a b c d e f a b c d e", None, "  a"]
    sets = list(shingles.set_rows(shingles.encoded(texts)))
    assert [len(s) for s in sets] == [len(shingles.shingle_set(t)) for t in texts]
    assert sets[1][0] in sets[0]  # equal after lower-casing
    random.seed(1)
    many = [" ".join(random.choices("abcdef", k=random.randrange(12))) for _ in range(300)]
    hashed = list(shingles.set_rows(shingles.encoded(many)))
    plain = [shingles.shingle_set(t) for t in many]
    for i in range(0, 300, 7):
        for j in range(300):
            assert len({*hashed[i].tolist()} & {*hashed[j].tolist()}) == len(plain[i] & plain[j])


def contained(rows, items, threshold=0.8):
    out = set()
    for doc_id, text in rows:
        words = shingles.words(text)
        for item_id, item in items:
            want = shingles.shingle_set(item)
            width = min(5, len(shingles.words(item)))
            have = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
            shared = len(want & have)
            if want and shared >= threshold * len(want) - 1e-9:
                out.add((doc_id, item_id, len(want), shared))
    return out


@pytest.mark.parametrize("size", [1_000_000, 40])
def test_contained_items(llm, documents, size, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 4, 5, 6, 20, 45])))) for i in range(30)]
    items += [(50, None), (51, ""), (0, items[0][1]), (None, items[5][1]), (None, items[6][1]), (2**53 + 1, items[5][1])]
    rows = []
    for i in range(150):
        text = rng.choices(words, k=rng.randrange(5, 400))
        for _ in range(rng.randrange(3)):
            part = list((rng.choice(items[:30])[1]).split())
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = "changed"
            text[10:10] = part
        rows.append((i, " ".join(text)))
    rows += [(200, None), (201, ""), (202, items[4][1].upper()), (202, "w " * 60_000 + items[5][1])]
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (size,))
    table = llm.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_shared int")
    docs = documents(rows)
    got = decontam.contained_items(docs, table).collect()
    assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got} == contained(rows, items)
    clean = decontam.decontaminate(docs, table)
    bad = {i for i, *_ in contained(rows, items)}
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in rows if i not in bad)


def test_decontamination_of_empty_tables(llm, documents):
    none = llm.createDataFrame([], "item_id long, text string")
    assert decontam.contained_items(documents([(1, "a")]), none).count() == 0
    assert decontam.decontaminate(documents([(1, "a")]), none).count() == 1
    assert decontam.contained_items(documents([]), llm.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_pipeline(llm):
    docs = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [(i, t) for i, t in docs if any(map(str.isalpha, t or ""))]
    least = {i: c for i, _, c in groups(kept)}
    kept = [(i, t) for i, t in kept if least[i] == i]
    bad = {i for i, *_ in contained(kept, items)}
    encode = packing.encoder(VOCABULARY)
    want = {}
    for doc_id, text in kept:
        if doc_id not in bad:
            at, parts = 0, []
            for start, _, stop, _ in secret_scan.find_secrets(text):
                parts += [text[at:start], "<SECRET>"] if start >= at else []
                at = max(at, stop)
            want[doc_id] = len(encode("".join([*parts, text[at:]]))) + 1
    got = Counter()
    for r in corpus_pipeline.run(llm, SF).collect():
        got[r.doc_id] += r.length
    assert got == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "packing"]


def test_stages_return_the_columns_of_documents(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(llm, docs, SF).columns == docs.columns
