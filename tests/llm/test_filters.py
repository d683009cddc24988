"""Quality rules, address rules, mixing, tokens and extraction on small fixtures."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import models

from touchline.llm import bpe, extract, markup, mixing, quality, unigram, urls
from touchline.llm.queries import URL_RULES


def test_quality_counts(documents, as_dict):
    long = " ".join(f"w{i}" for i in range(40))
    docs = {1: None, 2: "", 3: long, 4: "a b c d e " * 6, 5: "x\ny\nx\n\n \n\n" + long, 6: "# $ é"}
    found = as_dict(quality.quality_rules(documents(docs.items())))
    assert (found[1]["n_words"], found[1]["base_failed"], found[1]["kept"]) == (0, True, False)
    assert found[2]["word_chars"] == 0
    assert found[3]["n_repeat_words"] == 0 and not found[3]["base_failed"]
    assert found[4]["n_repeat_words"] == 30 and found[4]["base_failed"]
    assert found[5]["n_dup_lines"] == 1
    assert (found[6]["n_symbols"], found[6]["word_chars"]) == (2, 3)
    assert quality.quality_rules(documents([(1, "a")]).limit(0)).collect() == []


def test_host_verdicts(documents, as_dict):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [(i, good, "good") for i in range(40)]
    rows += [(100 + i, "bad", "bad") for i in range(30)] + [(150, good, "bad")]
    rows += [(200, "bad", "tiny"), (201, good, "tiny"), (300, good, None)]
    found = as_dict(quality.quality_rules(documents(rows)))
    assert found[0]["kept"] and found[300]["kept"]
    assert not found[150]["base_failed"] and not found[150]["kept"]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def test_address_parts_and_rules(spark, as_dict):
    addresses = {
        1: None, 2: "", 3: "no scheme", 4: "HTTP://A.Example.ORG", 5: "x://example.org/es/1?q=/en/1",
        6: "x://sub.example.org/en/12#a://b", 7: "x://badexample.org/es/", 8: "x://a.com/de/x",
        9: "x://a.com/fr/", 10: "x://a.net/?/p", 11: "x://a.net?p/q", 12: "://É.com/fr/",
    }
    pages = spark.createDataFrame(list(addresses.items()), "page_id long, url string")
    found = as_dict(urls.judged_urls(pages.selectExpr("*", "'x' AS tokens"), URL_RULES), "page_id")
    for i, url in addresses.items():
        host, path = host_path(url)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            r for r in URL_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        assert (found[i]["host"], found[i]["path"]) == (host, path)
        assert found[i]["rule"] == (best.host + best.path if best else None)
        if best:
            assert found[i]["verdict"] == best.verdict
    assert urls.judged_urls(pages.limit(0), URL_RULES).collect() == []


def brute_rules(rows, support, confidence):
    """(antecedent, verdict) -> confidence, by counting all subsets."""
    counts, total = Counter(), len(rows)
    for tokens, verdict in rows:
        for n in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), n):
                counts[part, None] += 1
                counts[part, verdict] += 1
    least = math.ceil(support * total)
    rules = {
        k: (n / counts[k[0], None], n) for k, n in counts.items() if k[1] and n >= least
    }
    kept = {}
    for (part, verdict), (conf, n) in rules.items():
        shorter = [tuple(x for x in part if x != t) for t in part]
        weak = any((s, verdict) in rules and rules[s, verdict][0] >= conf for s in shorter)
        if conf >= confidence and not weak:
            kept[part, verdict] = (conf, n)
    return kept


def test_mined_rules(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(200):
        tokens = sorted(rng.sample("abcdef", rng.randint(1, 4)))
        bad = "a" in tokens and "b" in tokens or rng.random() < 0.1
        rows.append((tokens, "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    found = {
        (tuple(r["antecedent"]), r["verdict"]): (r["confidence"], r["support"])
        for r in urls.mined_rules(labelled, 0.03, 0.8).collect()
    }
    assert found and found == brute_rules(rows, 0.03, 0.8)
    rules = urls.mined_rules(labelled, 0.03, 0.8)
    matched = urls.match_rules(labelled.select("tokens").distinct(), rules).collect()
    for r in matched:
        fits = [(c, len(a), v == "allow", v) for (a, v), (c, _) in found.items() if set(a) <= set(r["tokens"])]
        assert r["mined"] == max(fits)[3]


def water(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        rest = sum(w for s, w in weight.items() if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        over = {s for s in names if target[s] > most * sizes[s] and s not in full}
        if not over:
            return target
        full |= over


def test_mixing(documents):
    rng = random.Random(9)
    sources = ["a", "b", "c", "d", None, "e"]
    rows = [
        (i, " ".join("w" for _ in range(rng.randint(0, 60))), rng.choices(sources, [1, 9, 30, 5, 9, 2])[0])
        for i in range(600)
    ] + [(1000, None, "a"), (1001, "", None), (5, rows_text(7), "b"), (5, rows_text(7), "b")]
    docs = documents(rows)
    found = mixing.mixed(docs, block=40).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    target = water(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 60 and abs(taken[s] - target[s]) <= 0.05 * target[s] + 2
    again = mixing.mixed(docs.repartition(7), block=40).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mixed(docs.limit(0)).collect() == []


def rows_text(n):
    return " ".join("w" for _ in range(n))


def test_flight_keeps_sums():
    rng = np.random.default_rng(10)
    p, size = rng.random(500), rng.integers(0, 900, 500).astype(float)
    moved = mixing.flight(p, size, rng.random(500))
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2
    assert moved.sum() == pytest.approx(p.sum())
    assert moved @ size == pytest.approx(p @ size)


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_segments():
    codec = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(11)
    letters = "ab'sl 12\n\t !?é漢😀 .  "
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        ids = bpe.encode(text, codec, public_tokenizers.PATTERN, 3)
        assert ids.tolist() == codec.encode_ordinary(text)
        assert bpe.decode(ids, codec, 4) == text.encode()


def test_bpe_round_trip(documents, as_dict):
    docs = {1: None, 2: "", 3: "a" * 300_000, 4: "<|endoftext|>", 5: "'s 's\n\n x", 6: " " * 9}
    encoded = bpe.token_ids(documents(docs.items()), RANKS, public_tokenizers.PATTERN)
    back = as_dict(bpe.texts_of_ids(encoded, RANKS, public_tokenizers.PATTERN))
    assert {i: bytes(r["bytes"]).decode() for i, r in back.items()} == {
        i: t or "" for i, t in docs.items()
    }
    digests = as_dict(bpe.token_digests(documents(docs.items()), RANKS, public_tokenizers.PATTERN))
    assert digests[1]["n_tokens"] == 0 and digests[1]["ids_sha256"] == digests[2]["ids_sha256"]


def library(scores, byte_fallback):
    pieces = [("<unk>", 0.0)]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    return models.Unigram(pieces + list(scores.items()), 0, byte_fallback=byte_fallback)


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_ties(byte_fallback):
    scores = {
        "▁": -1.0, "a": -2.0, "b": -2.0, "ab": -4.0, "aa": -4.0, "ba": -3.0, "▁a": -3.0,
        "aba": -6.0, "▁ab": -5.0,
    }
    counter, model = unigram.CountingViterbi(scores, byte_fallback), library(scores, byte_fallback)
    rng = random.Random(12)
    for _ in range(3000):
        text = "".join(rng.choice("aabb c é") for _ in range(rng.randint(1, 14)))
        assert counter.count(text) == len(model.tokenize("▁" + text.replace(" ", "▁")))


def test_unigram_vocabulary(documents, as_dict):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = library(unigram.vocabulary(path), True)
    docs = {1: "The  quick\nbrown 漢字 fox😀", 2: None, 3: "", 4: "x" * 5000, 5: "▁ ▁▁<"}
    found = as_dict(unigram.token_counts(documents(docs.items()), path))
    for i, text in docs.items():
        want = len(model.tokenize("▁" + text.replace(" ", "▁"))) if text else 0
        assert found[i]["n_tokens"] == want
    with pytest.raises(ValueError):
        unigram.CountingViterbi({"▁": -1.0, "a▁b": -1.0})


PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body>'
    '<nav><ul><li><a href="/x">menu</a></li></ul></nav><div class="ad">buy {0}</div>'
    "<article><h1>Head {0}</h1><p><b>one &amp; {0}<br><p>two\n  lines {0} &copy</p>"
    '<div class="comments"><p>reader {0}</p></div><p>Accept our terms.</p></article>'
    "<footer>foot</footer>"
)


def test_extraction(spark, as_dict):
    rows = [(i, f"http://h.com/{i}", PAGE.format(f"n{i}")) for i in range(12)]
    plain = "<div><p>alpha beta {0}</p><p>gamma {0}</p></div><div class='sidebar'>side</div>"
    rows += [(100 + i, "http://p.com/", plain.format(i)) for i in range(3)]
    rows += [(200, None, None), (201, "x", ""), (202, "x", "just text &lt;b&gt;"), (203, "x", "<p>cut <b")]
    rows += [(204, "http://one.net/", PAGE.format("solo"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = as_dict(extract.extracted(pages.selectExpr("*", "'x' AS text", "1 AS row")), "page_id")
    # Nothing of an article is template, on however many pages it is.
    assert found[3]["text"] == "Head n3\none & n3\ntwo lines n3 ©\nAccept our terms."
    assert found[204]["text"] == "Head solo\none & solo\ntwo lines solo ©\nAccept our terms."
    assert found[101]["text"] == "alpha beta 1\ngamma 1"
    assert found[200]["text"] == found[201]["text"] == ""
    assert found[202]["text"] == "just text <b>"
    assert found[203]["text"].startswith("cut")
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert extract.extracted(pages.limit(0)).collect() == []


def extracted_texts(spark, as_dict, pages):
    """Texts of (url, html) in order."""
    rows = [(i, *page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = as_dict(extract.extracted(df), "page_id")
    return [found[i]["text"] for i in range(len(rows))]


def test_extraction_keeps_all_slots_of_hosts_without_article(spark, as_dict):
    one = "<body><div><h1>Title</h1><p>A long text of the page.</p></div></body>"
    two = (
        "<body><div class=part1><p>short {0} of four</p></div>"
        "<div class=part2><p>the longer part {0} of the page</p></div></body>"
    )
    named = "<article class=part1><p>one {0}</p></article><article class=part2><p>two {0}, more</p></article>"
    pages = [("http://one.com/", one)]
    pages += [("http://two.com/", two.format(i)) for i in range(3)]
    pages += [("http://named.com/", named.format(i)) for i in range(3)]
    found = extracted_texts(spark, as_dict, pages)
    assert found[0] == "Title\nA long text of the page."
    assert found[1:4] == [f"short {i} of four\nthe longer part {i} of the page" for i in range(3)]
    assert found[4:] == [f"one {i}\ntwo {i}, more" for i in range(3)]


def test_optional_parts_of_a_template(spark, as_dict):
    # Two of three pages hold an optional part; its date varies, its texts do not.
    part = "<div class=info><span>Posted on</span><p>{0}</p><p>All posts</p></div>"
    pages = []
    for i in range(12):
        html = f"<body><div><h1>Head {i}</h1><p>text {i}</p></div>"
        pages.append(("http://opt.com/", html + (part.format(f"May {i}") if i % 3 else "") + "</body>"))
    # A text that most pages share alone, in a slot that all pages have, is no class.
    pages += [
        ("http://own.com/", f"<p>own {i}</p>" + ("<p>shared</p>" if i else "<p>other</p>")) for i in range(12)
    ]
    found = extracted_texts(spark, as_dict, pages)
    want = [f"Head {i}\ntext {i}" + (f"\nMay {i}" if i % 3 else "") for i in range(12)]
    assert found[:12] == want
    assert found[12:] == ["own 0\nother"] + [f"own {i}\nshared" for i in range(1, 12)]


@pytest.mark.parametrize(
    "html",
    [
        "<div class='layout with-sidebar'>{}<div class=sidebar><p>side</p></div></div>",
        "<main class='has-sidebar'>{}</main>",
        "<article class='post comments-open'>{}<div class=comments><article>c</article></div></article>",
        "<div id='search-results'><main>{}</main></div><div class=related><p>" + "more " * 20 + "</p></div>",
        "<div class='widget-text'>{}</div>",
        "<article><div class='no-sidebar'>{}</div></article>",
        "<div class=ad-free><h1>Head</h1></div><div class=no-share><p>the text</p><p>more</p></div><nav>x</nav>",
        "<div class=ad><h1>Head</h1></div><div class=menu><p>the text</p></div><div class=share><p>more</p></div>",
    ],
)
def test_words_of_classes_never_empty_a_page(html):
    page = html.format("<h1>Head</h1><p>the text</p><p>more</p>")
    assert extract.main_text(page, [], frozenset()) == "Head\nthe text\nmore"


@pytest.mark.parametrize("tag", ["svg", "select", "button", "object", "canvas", "noscript"])
def test_elements_without_end_tag_swallow_nothing(tag):
    page = "<article><h1>T</h1>{}<p>one</p><p>two</p></article><p>three</p>"
    want = ["T", "one", "two", "three"]
    marks = [f'<{tag} class="i"/>', f"<{tag}>", f"<{tag}>x</{tag}>", f"<{tag}><{tag}>x</{tag}><b>y</b></{tag}>"]
    for mark in marks:
        found, _ = markup.blocks(page.format(mark))
        assert [b.text for b in found if not b.boiler] == want, mark
    # Inline in a paragraph, the text around it stays.
    found, _ = markup.blocks(f"<p>before <{tag}>x</{tag}> after</p>")
    assert [b.text for b in found] == ["before after"]
    # What holds an element ends it, also if its end tag comes later.
    found, _ = markup.blocks(f"<div><{tag}><p>one</p></div><p>two</p></{tag}>")
    assert [b.text for b in found] == ["one", "two"]


@pytest.mark.parametrize("n", [2, 9, 10])
def test_template_texts_at_every_host_size(spark, as_dict, n):
    plain = "<div><span>Home of all</span></div><div><p>text {0}</p></div><div>Imprint</div>"
    inside = "<p>Motto</p><article><p>text {0}</p><p>{1}</p></article>"
    pages = [("http://plain.com/", plain.format(i)) for i in range(n)]
    # A paragraph of the article that all pages but one share stays.
    pages += [("http://a.com/", inside.format(i, "shared" if i else "own")) for i in range(n)]
    found = extracted_texts(spark, as_dict, pages)
    assert found[:n] == [f"text {i}" for i in range(n)]
    assert found[n:] == [f"text {i}\n" + ("shared" if i else "own") for i in range(n)]


@pytest.mark.parametrize("n", [2, 9, 10])
def test_shared_paragraphs_are_content(spark, as_dict, n):
    """Alone in plain pages, and in an article, at every size of the host."""
    plain = "<div><p>text {0}</p><p>shared paragraph of content here</p></div>"
    article = "<article><p>text {0}</p><p>shared one</p><p>shared two</p></article>"
    pages = [("http://plain.com/", plain.format(i)) for i in range(n)]
    pages += [("http://a.com/", article.format(i)) for i in range(n)]
    found = extracted_texts(spark, as_dict, pages)
    assert found[:n] == [f"text {i}\nshared paragraph of content here" for i in range(n)]
    assert found[n:] == [f"text {i}\nshared one\nshared two" for i in range(n)]


def test_subjects_in_class_names():
    page = "<div class=legal-news><p>court ruling</p></div><div class=text><p>{}</p></div><div class=legal-box>terms</div>"
    assert extract.main_text(page.format("long " * 9), [], frozenset()) == "court ruling\n" + "long " * 8 + "long"


def test_repeated_pages_count_each(spark, as_dict):
    """Equal rows do not cancel: a text of one repeated page is no template of another."""
    pages = [("http://r.com/", "<p>one</p><p>two</p>")] * 2 + [("http://r.com/", "<p>three</p><p>four</p>")] * 2
    found = extracted_texts(spark, as_dict, pages)
    assert found == ["one\ntwo"] * 2 + ["three\nfour"] * 2


def test_texts_out_of_order_are_no_template(spark, as_dict):
    """Two texts that all pages have, in changing order, are no class of one template."""
    pages = [("http://o.com/", f"<p>own {i}</p>" + "<p>a</p><p>b</p>") for i in range(3)]
    mixed = [("http://m.com/", f"<p>own {i}</p>" + ("<p>a</p><p>x{0}</p><p>b</p>", "<p>b</p><p>a</p>")[i % 2]) for i in range(4)]
    found = extracted_texts(spark, as_dict, pages + mixed)
    assert found[:3] == [f"own {i}" for i in range(3)]
    assert all({"a", "b"} <= set(t.split("\n")) for t in found[3:])


def test_markup_paths():
    found, opened = markup.blocks("<main id=c12><p>a<p>b<i>c</i></main><ul><li>d<li>e</ul>")
    assert [(b.path, b.text) for b in found] == [
        ("/main.c0/p", "a"), ("/main.c0/p", "bc"), ("/ul/li", "d"), ("/ul/li", "e")
    ]
    assert opened["/main.c0/p"] == 2


def test_vectors_are_combined(spark):
    pages = spark.createDataFrame(
        [(1, "h", "<p>x</p><p>y</p>"), (2, "h", "<p>z</p><hr>")], "row long, host string, html string"
    )
    rows = extract.page_tokens(pages).filter(F.col("path") == "/p").collect()
    assert sorted(r["times"] for r in rows) == [1, 2]
