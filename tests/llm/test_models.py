"""Language identification, archives, nearest neighbours and packing."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import ann, language, packing, warc

SF = "/root/testdata/sf0.01"
VOCABULARY = packing.default_vocabulary()


def test_language_held_out_accuracy(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(llm):
    words = {"aa": "foo bar baz " * 30, "bb": "quux zyx wvu " * 30}
    rows = [(i, words[x] + str(i), x) for i in range(40) for x in words]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "123 !?", None), (103, "foo bar", None), (None, "zyx wvu", "bb"), (104, "foo " * 300_000, None)]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "'q' AS lang_pred")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "aa", "aa", "bb"]
    assert not got[None].held_out
    assert language.identify(df.filter("doc_id < 0")).count() == 0
    unlabelled = language.identify(df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.filter("doc_id IN (100, 101, 102)").count() == 0 and kept.count() == len(rows) - 3


def test_language_filters_hold_what_was_learned():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, 500).astype(np.uint64)
    words = np.zeros((1 << 12, 1), np.uint64)
    for place in language._places(grams, 12):
        words[place, 0] |= np.uint64(2)
    first, second = language._places(grams, 12)
    assert ((words[first] & words[second]) == 2).all()


def test_every_labelled_language_is_learned(llm):
    """Thousands of letters, no trigram twice; and more n-grams than a filter holds."""
    rng = random.Random(8)
    rows = [(i, "".join(chr(0x4E00 + rng.randrange(6000)) for _ in range(80)), "zh") for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choices("the of and a to in is you that it he was for on are".split(), k=60)), "en") for i in range(300)]
    rows += [(2000 + i, " ".join("".join(rng.choices("\u0430\u0431\u0432\u0433\u0434\u0435\u0436\u0437\u0438\u043a\u043b\u043c\u043d\u043e", k=6)) for _ in range(60)), "ru") for i in range(300)]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == truth[r.doc_id] and r.score > 0.5 for r in language.identify(df).collect())
    assert language.keep_identified(df).count() == len(rows)
    small = language.learn(df.select("text", "lang"), max_grams=200)
    assert small.languages == ["en", "ru", "zh"] and (small.fill * len(small.words) <= 2 * 300).all()
    names, _ = language.judge([t for _, t, _ in rows], small)
    assert np.mean([n == truth[i] for n, (i, *_) in zip(names, rows)]) > 0.99


def plain_judge(texts, train):
    """Shares of n-grams seen in each language, by sets: filters without false positives."""

    def grams(text):
        letters = [chr(c) if c != 32 else " " for c in (language._table()[ord(x)] for x in f"\n{text}\n")]
        line = " ".join("".join(letters).split())
        return [line_[i : i + 3] for line_ in [f" {line} "] for i in range(len(line) + 0) if line_[i + 1] != " "]

    known = {lang: {g for t, x in train if x == lang for g in grams(t)} for lang in sorted({x for _, x in train})}
    out = []
    for text in texts:
        mine = grams(text)
        shares = [sum(g in s for g in mine) / len(mine) for s in known.values()] if mine else []
        out.append((list(known)[int(np.argmax(shares))] if mine else "und", max(shares, default=0.0)))
    return out


def test_language_judge_against_plain_counting(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("text", "lang").limit(300).collect()
    train = [(r.text, r.lang) for r in docs if r.text and r.lang][:150]
    filters = language.learn(llm.createDataFrame(train, "text string, lang string"))
    texts = [r.text or "" for r in docs] + ["", "12 !", "a", "A b-c", "Zz\u0301 \u00c9t\u00e9"]
    names, scores = language.judge(texts, filters)
    want = plain_judge(texts, train)
    assert np.allclose(scores, [s for _, s in want], atol=0.02)
    assert [n for n, s in zip(names, scores) if s > 0.1] == [n for (n, _), s in zip(want, scores) if s > 0.1]


def archived(rows):
    groups = collections.defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = max((x for x in groups[html or ""] if x is not None), default=None)
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", first if revisit else None, True))
    return out


def by_text(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@pytest.mark.parametrize("split", ["300", "128m"])
def test_archives_with_magic_in_payloads(llm, split, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [
        (1, "u", fake), (2, "http://a b\r\n", fake + fake), (3, None, None), (4, "u", ""), (5, "u", "é日本" * 10),
        (6, "u", "é日本" * 10), (6, "u", "é日本" * 10), (None, "u", "z"), (7, "u", "WARC/1.1\r\n"), (8, "u", "\r\n\r\n"),
        (9, "u", "a\r\n\r\nWARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 9999999999999999999999\r\n\r\n"), (10, "u", "x" * 100_000),
        *((20 + i, "u", "copy") for i in range(30)),
    ]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS size", "'q' AS digest")
    old = llm.conf.get("spark.sql.files.maxPartitionBytes")
    llm.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archive(pages.coalesce(1), str(tmp_path / "a")).select(*COLUMNS).collect()
    finally:
        llm.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert by_text(got) == by_text(archived(rows))
    assert warc.archive(pages.filter("page_id < 0"), str(tmp_path / "b")).count() == 0


def test_archives_whole_table(llm):
    pages = llm.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert by_text(warc.archive(pages).select(*COLUMNS).collect()) == by_text(archived(rows))


def test_small_payloads_are_all_responses(llm):
    pages = llm.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.archive(pages, min_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def neighbours(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        scores = ann.cosines(np.repeat(x[i : i + 1], len(x), 0), x)
        best = {}
        for j in np.flatnonzero(ids != ids[i]):
            best[int(ids[j])] = max(scores[j], best.get(int(ids[j]), -2))
        out[int(ids[i])] = sorted(((-s, j) for j, s in best.items()))[:k]
    return out


def test_neighbours_recall(llm):
    vectors = llm.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    want = neighbours([(r.vec_id, r.embedding) for r in vectors.collect()])
    got = collections.defaultdict(dict)
    for r in ann.nearest(vectors, vectors.filter("vec_id % 50 = 0")).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    hits = [len({v for v, _ in got[q].values()} & {j for _, j in want[q]}) for q in want]
    assert np.mean(hits) / 5 >= 0.9


def test_neighbours_edges(llm, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(120)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(200, 260)] + [(60, rows[60][1])] * 8
    bad = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 1.0, 1.0]), (304, [float("nan")] * 4),
           (350, [float("inf"), 1.0, 1.0, 1.0]), (306, [1.0, 2.0]), (None, [1.0] * 4)]
    df = llm.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS part")
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df, df.filter("vec_id % 50 = 0"), probe_share=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((-r.score, r.vec_id))
    assert got == neighbours(rows)
    few = df.filter("vec_id IN (0, 1, 2)")
    assert [r.vec_id for r in ann.nearest(few, few.filter("vec_id = 0")).orderBy("rank").collect()] == [j for _, j in neighbours(rows[:3])[0]]
    assert ann.nearest(df.filter("vec_id < 0"), df).count() == 0


def test_neighbours_of_extreme_magnitudes_and_other_lengths(llm):
    rows = [(0, [1.0, 1.0]), (1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [5e-324, 5e-324]), (4, [1.7e308, 0.0]), (5, [-1e-310, -1e-310])]
    rows += [(50, [1.0, 0.0, 1e-300]), (51, [0.0, 1e300, 0.0]), (52, [3.0, 0.0, 0.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(ann.nearest(df, df.filter("vec_id % 50 = 0")).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    # equal but for the last bit
    assert sorted(got[0], key=lambda x: (-x[1], x[0])) == [(1, 1.0), (2, 1.0), (3, 1.0), (4, round(0.5**0.5, 12)), (5, -1.0)]
    assert got[50] == [(52, 1.0), (51, 0.0)]


def test_parts_are_balanced():
    x = ann.unit(np.random.default_rng(3).normal(size=(600, 8)))
    sizes = np.bincount(ann.balanced_parts(ann.neighbour_graph(x, 10), 12), minlength=12)
    assert sizes.sum() == 600 and sizes.max() <= 53


def packed(llm, rows, **options):
    df = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS piece", "2 AS rank", "3 AS length")
    got = packing.pack(packing.token_pieces(df, VOCABULARY, **options), options.get("capacity", 1024)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    capacity = options.get("capacity", 1024)
    want = collections.Counter()
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return got, len(sequences), -(-sum(r.length for r in got) // capacity)


def test_packing_edges(llm):
    rng = random.Random(4)
    words = "the of and in is éà 日本 123 <|endoftext|> x\n\n".split(" ")
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " " * 3000), (203, "word " * 3000), (7, rows[7][1]), (7, rows[7][1]), (None, "x"), (204, "ab" * 20_000)]
    _, used, least = packed(llm, rows, capacity=64)
    assert used <= least * 1.08
    assert packing.pack(packing.token_pieces(llm.createDataFrame([], "doc_id long, text string"), VOCABULARY)).count() == 0


def test_packing_whole_table(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    _, used, least = packed(llm, rows)
    assert used <= least * 1.01


def test_sequences_hold_the_ids(llm):
    df = llm.createDataFrame([(1, "hello world"), (2, "a b c")], "doc_id long, text string")
    out = packing.sequences(packing.pack(packing.token_pieces(df, VOCABULARY, with_ids=True))).collect()
    assert len(out) == 1 and list(out[0].ids).count(2) == 2


def test_encoders_agree():
    fast, whole = (packing.encoder(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("tiktoken", "json"))
    for text in ("", "<|endoftext|> a <|endoftext|>", " " * 2_000_000, "a" * 20_000, "é日本😀\n\t  x", "".join(map(chr, range(1, 3000)))):
        assert (fast(text) == whole(text)).all()
