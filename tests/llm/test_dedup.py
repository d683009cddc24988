"""Line, byte, near and exact deduplication against brute force on small fixtures."""

import hashlib
import random
import re

import numpy as np
import pytest

from touchline.llm import anchors, exact, grouping, linking, lines, near, repeats

from .test_queries import components

BLANK = re.compile(r"[\x20\x09-\x0d]")
EDGES = [(100, None), (101, ""), (102, " \n\t"), (103, None), (104, "a"), (105, "x" * 200_000)]


def line_copies(docs, k):
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        every = (text or "").split("\n")
        worded = [(a, x) for a, x in enumerate(every) if BLANK.sub("", x)]
        gone = set()
        # From single lines on, runs of two bring the blank lines inside of longer runs.
        for p, n in ((p, n) for p in range(len(worded)) for n in {k, max(k, 2)}):
            if p + n > len(worded):
                continue
            window = tuple(x for _, x in worded[p : p + n])
            if window in seen:
                gone.update(range(worded[p][0], worded[p + n - 1][0] + 1))
            seen.add(window)
        out[i] = ("\n".join(x for a, x in enumerate(every) if a not in gone), len(gone))
    return out


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_lines(documents, as_dict, k):
    rng = random.Random(k)
    docs = {
        i: "\n".join(rng.choice(["a", "b", "c", "", " "]) for _ in range(rng.randint(0, 14)))
        for i in range(25)
    } | dict(EDGES)
    found = as_dict(lines.deduplicated_lines(documents(docs.items()), min_lines=k))
    want = line_copies(docs, k)
    assert {i: (r["text"], r["n_removed"]) for i, r in found.items()} == want


def test_lines_without_repeats_or_rows(documents):
    same = lines.deduplicated_lines(documents([(1, "a\nb"), (2, "c\nd")])).collect()
    assert {r["text"] for r in same} == {"a\nb", "c\nd"}
    assert lines.deduplicated_lines(documents([(1, "a")]).limit(0)).collect() == []


def test_single_lines(documents, as_dict):
    """A long line between unlike lines, and a document of one line, are later copies."""
    line = " ".join(f"w{k}" for k in range(60))
    docs = {1: f"a\n{line}\nb", 2: f"c\n{line}\nd", 3: "whole text", 4: "whole text", 5: "e"}
    found = as_dict(lines.deduplicated_lines(documents(docs.items())))
    assert {i: r["text"] for i, r in found.items()} == {1: docs[1], 2: "c\nd", 3: "whole text", 4: "", 5: "e"}


def byte_copies(docs):
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for x in bytes(gone).split(b"\0") if x)
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("contexts", [500, 3])
def test_bytes(documents, as_dict, monkeypatch, contexts):
    monkeypatch.setattr(repeats, "CONTEXTS", contexts)
    rng = random.Random(5)
    base = ["".join(rng.choice("abc é") for _ in range(400)) for _ in range(3)]

    def piece():
        return rng.choice(["a", "aé" * 150, "a" * 230]) + rng.choice(base)[rng.randint(0, 200) :]

    docs = {i: "".join(piece() for _ in range(rng.randint(0, 4))) for i in range(30)} | dict(EDGES)
    found = as_dict(repeats.without_repeats(documents(docs.items())))
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {i: tuple(r[c] for c in columns) for i, r in found.items()} == byte_copies(docs)
    assert repeats.without_repeats(documents([(1, "a")]).limit(0)).collect() == []


def test_contexts_of_one_text_are_dealt_to_parts(spark):
    # One text owns all 2000 contexts of a hot anchor: parts hold about CONTEXTS of them.
    owners = spark.range(2000).selectExpr(
        "1L AS gram", "4L AS parts", "7L AS doc", "shiftleft(id * 10, 16) + 1 AS at"
    )
    texts = spark.createDataFrame([(7, bytearray(b"ab" * 10_100))], "doc long, text binary")
    sizes = [r["count"] for r in repeats._contexts(owners, texts).groupBy("part").count().collect()]
    assert sum(sizes) == 2000 and len(sizes) == 4 and max(sizes) < 600


def test_contexts_that_cannot_repeat_are_not_ordered(monkeypatch):
    rng = random.Random(4)
    anchor = "".join(rng.choice("klm") for _ in range(32))
    shared = "".join(rng.choice("xyz") for _ in range(60))

    def context(doc, before, after):
        return (1, 0, 1, doc, 10, (before + anchor + after).encode(), len(before))

    noise = [["".join(rng.choice("abc") for _ in range(60)) for _ in range(2)] for _ in range(20)]
    rows = [context(k, *pair) for k, pair in enumerate(noise)]
    rows += [context(30, noise[0][0], shared), context(31, noise[1][1], shared), context(32, "ab" + shared, shared[:40])]
    rows += [context(33, "b" + shared, shared[:30]), context(34, "", "")]
    ordered = []

    def recorded(texts, length):
        ordered.extend(texts)
        return grouping.prefix_intervals(texts, length)

    whole = [
        (r[3], r[4] + i) for r in rows for i in range(len(r[5]) - 99)
        if any(r[5][i : i + 100] in o[5] for o in rows if o[3] < r[3])
    ]
    monkeypatch.setattr(repeats, "prefix_intervals", recorded)
    found = [(doc, s) for _, doc, start, end in repeats._of_bucket(rows) for s in range(start, end - 99)]
    assert found == whole and len(whole) > 20
    assert len(ordered) < 8 and repeats._repeating(rows[:20]) == []


def test_contexts_equal_as_cut_are_ordered_once(monkeypatch):
    rng = random.Random(3)
    shared = "".join(rng.choice("klmxyz") for _ in range(120)).encode()
    rows = [(1, 0, 1, doc, 9, b"%d" % doc + shared + b"%d" % doc, 41) for doc in (4, 2, 3)]
    ordered = []

    def recorded(texts, length):
        ordered.extend(texts)
        return grouping.prefix_intervals(texts, length)

    monkeypatch.setattr(repeats, "prefix_intervals", recorded)
    assert list(repeats._of_bucket(rows)) == [(None, 3, 10, 130), (None, 4, 10, 130)]
    assert ordered == [shared]


@pytest.mark.parametrize("piece", [256, 1 << 16])
def test_anchors_of_equal_strings_are_equal(monkeypatch, piece):
    """Every string has one owner; equal strings have it in the same place, also across pieces."""
    monkeypatch.setattr(anchors, "PIECE", piece)
    rng = random.Random(2)
    shared = bytes(rng.choice(b"abc") for _ in range(300))
    texts = [b"x" * 70 + shared, b"short", shared[:99], b"yz" * 400 + shared, shared[50:], b"a" * 400]
    data = np.frombuffer(b"".join(texts), "u1")
    owner, contexts, equal = {}, {}, {}
    for found in anchors.find(data, np.cumsum([0, *map(len, texts)])):
        for text, place, left, owned, gram, context in zip(*found, strict=True):
            start = place - left
            raw = texts[text][start : start + owned + anchors.LENGTH - 1]
            assert contexts.setdefault(context, (raw, left)) == (raw, left)
            for s in range(start, start + owned):
                assert owner.setdefault((text, s), (gram, place - s)) == (gram, place - s)
    for (text, s), anchor in owner.items():
        string = texts[text][s : s + anchors.LENGTH]
        assert equal.setdefault(string, anchor) == anchor and 0 <= anchor[1] <= 68
    assert len(owner) == sum(max(0, len(t) - 99) for t in texts)


def test_bytes_of_ids_with_unlike_texts(documents):
    """Rows without an id, and unlike texts of one id, are documents of their own."""
    rng = random.Random(9)
    a, b, c = ("".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(3))
    rows = [(1, a), (None, f"{a}x"), (None, b), (3, c), (3, f"{c}y"), (2, b[:150]), (None, b)]
    found = {}
    for r in repeats.without_repeats(documents(rows)).collect():
        found.setdefault((r["doc_id"], r["n_bytes"]), set()).add((r["n_removed"], r["kept_sha256"]))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert found[1, 300] == {(0, sha(a))} and found[2, 150] == {(0, sha(b[:150]))}
    assert found[None, 301] == {(300, sha("x"))} and found[None, 300] == {(150, sha(b[150:]))}
    # Of the two texts of id 3 the one with the smaller hash counts as the earlier one.
    assert (found[3, 300], found[3, 301]) in [
        ({(0, sha(c))}, {(300, sha("y"))}), ({(300, sha(""))}, {(0, sha(f"{c}y"))}),
    ]


def test_one_text_with_a_hot_anchor(documents, as_dict, monkeypatch):
    monkeypatch.setattr(repeats, "CONTEXTS", 3)
    rng = random.Random(8)
    hot = "0123456789abcdefghijklmnopqrstuv"
    around = ["".join(rng.choice("xyz ") for _ in range(90)) for _ in range(12)]
    docs = {1: "".join(rng.choice(around) + hot for _ in range(60)), 2: around[0] + hot + around[1]}
    found = as_dict(repeats.without_repeats(documents(docs.items())))
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {i: tuple(r[c] for c in columns) for i, r in found.items()} == byte_copies(docs)


def test_suffix_array():
    rng = random.Random(6)
    for _ in range(300):
        texts = [
            bytes(rng.choice(b"ab\0c") for _ in range(rng.randint(0, 12)))
            for _ in range(rng.randint(1, 5))
        ]
        got = [texts[k][i:] for k, i in grouping.suffix_array(texts)]
        assert got == sorted(t[i:] for t in texts for i in range(len(t)))


def variants(rng, words, n):
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 999)}"
        yield " ".join(own)


def test_near(documents, as_dict):
    rng = random.Random(7)
    docs, passage = dict(EDGES), [f"p{i}" for i in range(60)]
    for group in range(4):
        words = [f"g{group}v{rng.randint(0, 10**6)}" for _ in range(rng.choice([6, 40, 90]))]
        for text in variants(rng, words, 8):
            docs[len(docs)] = text if rng.random() < 0.5 else text.upper()
    for i in range(20):  # one passage, most of each text
        docs[300 + i] = " ".join(passage + [f"q{i}x{k}" for k in range(rng.randint(5, 30))])
    docs[400], docs[401], docs[402] = "a b c", "A  B\nc", "a b d"
    want, sizes = components(docs)
    found = as_dict(near.near_duplicates(documents(docs.items())))
    assert {i: r["component_id"] for i, r in found.items()} == want
    assert {i: r["n_shingles"] for i, r in found.items()} == sizes
    assert all(r["kept"] == (i == want[i]) for i, r in found.items())


def test_near_without_links_or_rows(documents, as_dict):
    found = as_dict(near.near_duplicates(documents([(1, "a b c d e f"), (2, None), (None, "z")])))
    assert found[1]["kept"] and found[2]["component_id"] == 2 and found[None]["kept"]
    assert near.near_duplicates(documents([(1, "a")]).limit(0)).collect() == []


def test_rows_that_may_be_wanted(spark):
    rows = spark.range(20_000).selectExpr("IF(id = 5, NULL, id) AS k", "id")
    wanted = spark.createDataFrame([(i,) for i in (None, 3, 19_999, 7, 7, -4)], "w long")
    found = {r["id"] for r in linking.possibly_in(rows, "k", wanted).collect()}
    assert found >= {3, 5, 7, 19_999} and len(found) < 100
    assert linking.possibly_in(rows, "k", wanted.limit(0)).count() == 0


def test_near_sets_of_other_ids_are_not_built(documents):
    texts = [(i, f"w{i} a b c d e f g h {i}") for i in range(50)]
    docs = documents([*texts, (None, texts[3][1]), (None, "n u l l i d s"), (3, "x y z u v w")])
    every = {r["n"]: r["node"] for r in linking.set_table(documents(texts[3:4]), "text", 1, 0).collect()}
    spark = docs.sparkSession
    members = spark.createDataFrame([(n, 3) for n in every.values()], "__node long, first long")
    assert [r["node"] for r in linking.set_table(docs, "text", 1, 0, members, "doc_id").collect()] == [
        *every.values()
    ]
    node = linking.set_table(documents([(None, "n u l l i d s")]), "text", 1, 0).first()["node"]
    members = spark.createDataFrame([(node, None)], "__node long, first long")
    assert linking.set_table(docs, "text", 1, 0, members, "doc_id").first()["n"] == 3


def test_near_ids(documents):
    """Rows without an id, and unlike texts of one id, are documents of their own."""
    words = [f"w{k}" for k in range(40)]
    copy = " ".join(words)
    rows = [
        (None, copy), (None, copy + " more"), (7, copy + " other"), (9, copy + " again"),
        (5, "an unlike text of some words here"), (5, copy.upper()),
        (None, "alone without any id at all"), (None, "alone without any id at all"),
    ]
    found = near.near_duplicates(documents(rows)).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in found), key=repr) == sorted(
        [(None, 5, False)] * 2 + [(7, 5, False), (9, 5, False), (5, 5, True), (5, 5, True)]
        + [(None, None, True)] * 2,
        key=repr,
    )


def test_near_texts_of_one_passage_do_not_meet(spark):
    """Texts that share most of their words, but too few: no candidates, however many they are."""
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"q{k}x{j}" for j in range(10))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    described = near.described(docs, "text", "doc_id").withColumnRenamed("n_shingles", "n").cache()
    sizes = described.select("node", "n")
    posted = near.postings(described).join(sizes, "node")
    sets = linking.set_table(docs, "text", 1, 0)
    assert posted.count() > 0 and linking.prefix_pairs(posted, None, sets, 75).count() == 0


def test_exact(documents, as_dict):
    docs = {1: "a b", 2: "ab", 3: "a  b", 4: "A b", 5: "ab\n ", 6: None, 7: "", 8: "\t", 9: "x"}
    found = as_dict(exact.exact_duplicates(documents(docs.items()), salts=3))
    # 3 and 5 are longest, 3 is smaller; of the empty ones 8 is longest.
    assert {i: r["keep_id"] for i, r in found.items()} == {
        1: 3, 2: 3, 3: 3, 4: 4, 5: 3, 6: 8, 7: 8, 8: 8, 9: 9
    }
    assert found[1]["group_size"] == 4 and found[6]["group_size"] == 3
    assert found[3]["kept"] and not found[1]["kept"]
    assert found[9]["text_sha256"] == hashlib.sha256(b"x").hexdigest()


def test_exact_ids(documents):
    rows = documents([(None, "a"), (5, "a"), (5, "a"), (-3, "b"), (2, "b")])
    found = [(r["doc_id"], r["keep_id"], r["kept"]) for r in exact.exact_duplicates(rows).collect()]
    want = [(None, 5, False), (5, 5, True), (5, 5, True), (-3, -3, True), (2, -3, False)]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert exact.exact_duplicates(rows.limit(0)).collect() == []
