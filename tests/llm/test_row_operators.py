"""Operators that judge rows one by one: repetition rules, personal data, byte-level BPE, toxicity, HTML."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallycart.llm import bpe, html, pii, repetition, semicrf, toxicity
from tallycart.llm.common import pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "\n\n", "a", "word " * 30_000, "x" * 200_000, "é😀 中文\tb\x0b", "same same", "same same", "<p>", "+1 (269) 555-3296"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, repeated rows and extra columns whose names clash with results."""
    rows = [(k if k != 3 else None, t, "en", "s", len(t or ""), True, "x", 1) for k, t in enumerate(ODD)]
    rows += rows[-2:]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, score int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# -- repetition


def brute_repetition(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
    repeat = {j + d for j in range(len(w) - 2) if tri[tuple(w[j : j + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": len(repeat)}
    out["base_failed"] = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
    for n in range(5, 11):
        known, inside = set(), set()
        for j in range(len(w) - n + 1):
            if tuple(w[j : j + n]) in known:
                inside |= set(range(j, j + n))
            known.add(tuple(w[j : j + n]))
        out[f"dup_{n}gram_chars"] = sum(len(w[j]) for j in inside)
    return out


def test_repetition_equals_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "bb", "é", " ", "\n", "\t", "#", "a bb é ", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    found = repetition.measured(texts, repetition.Limits())
    for k, text in enumerate(texts):
        want = brute_repetition(text)
        assert {c: int(found[c][k]) for c in want} == {c: int(v) for c, v in want.items()}, text


def test_repetition_odd_rows(spark, odd):
    rows = repetition.repetition(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[0].n_words, by[1].n_words, by[0].kept, by[0].base_failed) == (0, 0, False, True)
    assert by[5].n_words == 30_000 and by[5].base_failed
    assert repetition.repetition(empty(spark)).collect() == []


def test_repetition_rejects_copied_passages_only():
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = words(30)
    clean, copied = words(200), "\n".join([words(60), passage, words(20), passage])
    found = repetition.measured([clean, copied], repetition.Limits())
    assert found["kept"].tolist() == [True, False]


# -- personal data


def brute_spans(text):
    only = lambda s: re.sub("[^0-9]", "", s)

    def checked(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(only(m.group())) <= 19 and checked(only(m.group()))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(only(m.group())) <= 15],
    }


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for alphabet in ("a@._.-%1", "12 .-+(", "0123456789", "@a.b", "+12 ().-", "1.250.", "٣1.@+"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24)))
            assert pii.base_spans(text) == brute_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 100_000, "a@" * 100_000, "+1 " * 100_000, "1." * 100_000):
        pii.base_spans(text)


def test_semicrf_against_all_segmentations():
    rng = np.random.default_rng(4)
    spans = [(0, 1), (0, 2), (1, 2), (1, 3), (2, 4), (3, 4)]
    net = semicrf.Lattice(4, np.array([a for a, _ in spans]), np.array([b for _, b in spans]), np.zeros((6, 1), dtype=int))
    order = np.argsort(net.ends, kind="stable")
    net = semicrf.Lattice(4, net.starts[order], net.ends[order], net.features)
    scores = rng.normal(size=(6, 2))
    ways = []
    for r in range(4):
        for chosen in itertools.combinations(range(6), r):
            if all(net.ends[a] <= net.starts[b] for a, b in itertools.pairwise(sorted(chosen, key=lambda s: net.starts[s]))):
                for kinds in itertools.product(range(2), repeat=r):
                    ways.append((sum(scores[s, k] for s, k in zip(chosen, kinds, strict=True)), dict(zip(chosen, kinds, strict=True))))
    total = np.log(sum(np.exp(w) for w, _ in ways))
    log_z, marginal = semicrf.log_partition(net, scores)
    assert np.isclose(log_z, total)
    for s in range(6):
        for k in range(2):
            assert np.isclose(marginal[s, k], sum(np.exp(w - total) for w, c in ways if c.get(s) == k))
    top = max(ways, key=lambda w: w[0])[1]
    found = {(a, b): k for a, b, k in semicrf.best(net, scores)}
    assert found == {(int(net.starts[s]), int(net.ends[s])): k for s, k in top.items()}


def test_crf_adds_other_forms_and_leaves_plain_numbers():
    model = pii.trained([], pii.Settings())
    found = lambda text: [(k, text[a:b]) for k, a, b in model.added(text, pii.base_spans(text))]
    assert found("please call 555-301-9988 today") == [("phone", "555-301-9988")]
    assert found("write to bob (at) corp (dot) com now") == [("email", "bob (at) corp (dot) com")]
    assert found("reach +1 (269) 555-3296 4524132264652876 now")  # one long match that the base patterns drop
    for text in ("in 2021 we sold 120 of 450 items", "version 4.0.1 of 2021-03-04", "no digits here", "", "see page 12"):
        assert found(text) == []


def test_pii_rows(spark, odd):
    rows = pii.pii_spans(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id == 11:
            assert r.n_phone == 1 and r.spans == "phone:0:17"
            assert r.base_sha256 == hashlib.sha256(b"phone:0:17").hexdigest()
        if r.doc_id in (0, 1):
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) == (0, 0, 0, 0, "")
            assert r.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.pii_spans(empty(spark)).collect() == []


def test_redaction_keeps_columns_and_masks_overlaps(spark, odd):
    out = pii.redacted(odd)
    assert out.columns == odd.columns
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[11].text == "<PHONE>" and by[11].n_chars == 7 and by[0].text is None and by[0].kept is True
    assert pii.masked("abcdef", "email:1:3,ip:2:5") == "a<EMAIL>f"


# -- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_usual_encoder(reference):
    rng = random.Random(5)
    pool = ["a", "aa", " ", "  ", "\n", "the", "ing", "é", "ß", "1", "23", "!!", "===", "中文", "😀", "\xa0", "'s", "'ll", "\x1c", "\x85", "Ⅷ", "١", "א", "_", "AAAA", "<|endoftext|>"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["a" * 3000, "=" * 2001, "ab" * 1500, "", "the" * 700]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for a, b in pieces(texts, 20_000):
        for words, text in encoder.encoded(texts[a:b]):
            ids = [int(x) for w in words for x in w[0].split(",") if x]
            assert ids == reference.encode_ordinary(text)
            assert encoder.decode(ids).decode() == text and sum(w[1] for w in words) == len(ids)


def test_bpe_with_ranks_that_turn_back(tmp_path):
    """Any rank file: merges of one rank may make a pair of a lower one."""
    rng = random.Random(6)
    tokens = [bytes([b]) for b in range(256)]
    more = [bytes(x) for n in (2, 3, 4, 5) for x in itertools.product(b"abc", repeat=n)]
    rng.shuffle(more)
    tokens += more[:150]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    ranks = {t: k for k, t in enumerate(tokens)}
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    ids, ends = bpe.replay(words, bpe.Ranks(str(path)))
    begin = 0
    for word, end in zip(words, ends.tolist(), strict=True):
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert ids[begin:end].tolist() == [ranks[p] for p in parts], word
        begin = end


def test_bpe_rows(spark, odd, reference):
    rows = bpe.tokens(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is not None:
            ids = reference.encode_ordinary(ODD[r.doc_id] or "")
            assert r.ids == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()
    assert bpe.tokens(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []


# -- toxicity


def test_block_max_search_is_exact():
    rng = np.random.default_rng(7)

    class Row:
        def __init__(self, k, terms, counts):
            self.doc_id, self.toxic, self.terms, self.counts = k, int(k % 2), terms, counts

    drawn = []
    for k in range(700):
        terms = sorted(rng.choice(60, rng.integers(0, 8), replace=False).tolist())
        drawn.append(Row(k, terms, rng.integers(1, 5, len(terms)).tolist()))
    idf = rng.uniform(1, 6, 60)
    index = toxicity.indexed(drawn, {str(t): t for t in range(60)}, idf, {0: 350, 1: 350}, {0: 350, 1: 350}, toxicity.Settings(block=16))
    vectors = np.zeros((len(index.ids), 60))
    by = {r.doc_id: r for r in drawn}
    for row, k in enumerate(index.ids):
        r = by[k]
        w = (1 + np.log(r.counts)) * idf[r.terms]
        vectors[row, r.terms] = w / np.sqrt(w @ w)
    for _ in range(200):
        terms = np.array(sorted(rng.choice(60, rng.integers(1, 8), replace=False).tolist()))
        t, w = index.vector(terms, rng.integers(1, 4, len(terms)))
        cosines = vectors[:, t] @ w
        order = np.lexsort((index.rank, -np.round(cosines, 6)))[:16]
        _, scores = index.nearest(t, w, 16)
        assert np.allclose(np.sort(scores)[::-1], [c for c in cosines[order] if c > 0], atol=1e-6)


def test_terms_are_numbered_in_order_and_kept_by_how_often_examples_hold_them(spark):
    texts = {k: f"Often rare{k} " + "half " * (k % 2) + "often" * (k == 4) for k in range(12)} | {12: None, 13: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, k % 2) for k in texts], "doc_id long, toxic int")
    index = toxicity.build(docs, labels, "doc_id", "text", toxicity.Settings())
    learned = [k for k in texts if zlib.crc32(str(k).encode()) % 5]
    held = Counter(w for k in learned for w in set(re.findall(r"[^\W_]+", (texts[k] or "").lower())))
    assert {w: k for k, w in enumerate(sorted(held))} == index.numbers
    assert [held[w] for w in index.numbers] == sorted(held.values(), reverse=True)
    everywhere = Counter(w for t in texts.values() for w in set(re.findall(r"[^\W_]+", (t or "").lower())))
    sent = spark.sparkContext.broadcast(index.numbers)
    total, counts = toxicity.document_counts(docs, "text", sent, len(held))
    assert total == 14 and {w: counts[k] for w, k in index.numbers.items()} == {w: everywhere[w] for w in held}


def test_blocks_below_the_kth_cosine_are_skipped():
    """Examples of eight languages: a text of one reads the blocks of its own, and finds what all examples would give."""
    rng = np.random.default_rng(3)

    class Row:
        def __init__(self, k):
            self.doc_id, self.toxic, own = k, int(k % 2), 40 * (k % 8)
            self.terms = np.array(sorted(rng.choice(40, 12, replace=False) + own).copy())
            self.counts = rng.integers(1, 4, 12)

    drawn = [Row(k) for k in range(1024)]
    index = toxicity.indexed(drawn, {str(t): t for t in range(320)}, rng.uniform(1, 4, 320), {0: 512, 1: 512}, {0: 512, 1: 512}, toxicity.Settings(block=32, common=0.001))
    read = []
    for r in drawn[:64]:
        terms, weights = index.vector(r.terms[:9], r.counts[:9])
        rows, cosines, blocks = index.search(terms, weights, 16)
        full = (weights @ index.dense.transpose(1, 0, 2).reshape(320, -1)[index.place[terms]])[: len(index.ids)]
        best = np.lexsort((index.rank, -np.round(full, 6)))[:16]
        assert np.allclose(cosines, full[best], atol=1e-5) and np.abs(np.sort(index.rank[rows]) - np.sort(index.rank[best])).max() == 0
        read.append(blocks)
    assert max(read) <= 8 and len(index.tops[0]) == 32


def test_ties_of_cosine_go_to_the_first_example_by_terms():
    class Row:
        def __init__(self, k, terms):
            self.doc_id, self.toxic, self.terms, self.counts = k, 0, np.array(terms), np.ones(len(terms), dtype=int)

    drawn = [Row(k, [0, 1 + k % 5]) for k in range(50)] + [Row(99, [7])]
    index = toxicity.indexed(drawn, {str(t): t for t in range(8)}, np.ones(8), {0: 51, 1: 1}, {0: 51, 1: 1}, toxicity.Settings(block=4))
    rows, cosines = index.nearest(*index.vector(np.array([0]), np.array([1])), 16)
    want = sorted(range(50), key=lambda k: (np.array([0, 1 + k % 5], dtype=np.int32).tobytes(), np.ones(2, dtype=np.int32).tobytes(), str(k)))[:16]
    assert index.ids[rows].tolist() == want and np.allclose(cosines, cosines[0])


def test_scores_on_the_held_out_fold_are_reliable(spark):
    """sf0.1: toxic texts are found, clean ones left, and scores mean what they say."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    caught, flagged = rows[rows.toxic == 1].predicted.sum(), rows[rows.toxic == 0].predicted.sum()
    assert caught >= 0.9 * (rows.toxic == 1).sum() and flagged <= 10
    assert ((rows.score - rows.toxic) ** 2).mean() < 0.02
    for low, high in ((0, 0.1), (0.9, 1.01)):
        inside = rows[(rows.score >= low) & (rows.score < high)]
        assert len(inside) > 20 and abs(inside.toxic.mean() - inside.score.mean()) < 0.1


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 5)))
    docs, labels = [], []
    for k in range(600):
        words = [word() for _ in range(rng.randint(5, 60))]
        bad = k % 5 == 1 or k % 7 == 3
        if bad:
            words.insert(rng.randint(0, len(words)), rng.choice(["vilefool", "VILEfooling!", "nastyrot", "nastyrots"]))
        docs.append((k, " ".join(words), bad))
        labels.append((k, 1, int(bad)))
    labels += [(None, 1, 1), (900, 1, None), (5, 1, 0), (5, 1, 0)]
    return spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs


def test_toxicity_learns_on_one_fold_and_finds_the_other(spark, labelled):
    docs, labels, truth = labelled
    rows = {r.doc_id: r for r in toxicity.toxic_scores(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    held = [(rows[k].predicted, int(bad)) for k, _, bad in truth if rows[k].held_out]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_learned(spark, labelled):
    docs, labels, _ = labelled
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    scores = lambda t: sorted((r.doc_id, r.score) for r in toxicity.toxic_scores(docs, t).collect())
    assert scores(labels) == scores(flipped)


def test_toxicity_odd_rows(spark, odd, labelled):
    _, labels, _ = labelled
    for given in (labels, labels.where("false"), labels.where("toxic = 0")):
        out = toxicity.toxicity(odd, given).select("row.*", "score", "predicted").collect()
        assert len(out) == odd.count() and all(0 <= r[-2] <= 1 for r in out)
    assert toxicity.toxic_scores(empty(spark), labels).collect() == []
    assert toxicity.without_toxic(odd, labels).columns == odd.columns


def plain_cosine_table(spark, n_toxic, n_clean):
    """Labelled training texts of words of their own, the toxic ones with one of 10 marks; ids stay outside the held-out fold."""
    ids = [k for k in range(10_000) if zlib.crc32(str(k).encode()) % 5][: n_toxic + n_clean]
    texts = [" ".join(f"w{k}x{j}" for j in range(20)) + (f" mark{chr(97 + k % 10)}" if i < n_toxic else "") for i, k in enumerate(ids)]
    labels = [(k, 1, int(i < n_toxic)) for i, k in enumerate(ids)]
    return ids, texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_whole_texts_enter_the_cosine(spark):
    ids, texts, labels = plain_cosine_table(spark, 60, 120)
    held = [k for k in range(10_000, 10_100) if not zlib.crc32(str(k).encode()) % 5]
    copy = texts[0].rsplit(" ", 1)[0]  # the first toxic text without its mark
    docs = spark.createDataFrame([*zip(ids, texts, strict=True), (held[0], copy)], "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.toxic_scores(docs, labels).collect()}
    assert rows[held[0]].evidence[0] == ids[0] and rows[held[0]].predicted == 1


def test_marks_count_alike_at_every_size_and_balance(spark):
    for n_toxic, n_clean in ((60, 60), (60, 480), (200, 200)):
        ids, texts, labels = plain_cosine_table(spark, n_toxic, n_clean)
        docs = spark.createDataFrame([*zip(ids, texts, strict=True), (20_000, "fresh words markc")], "doc_id long, text string")
        rows = {r.doc_id: r for r in toxicity.toxic_scores(docs, labels).collect()}
        assert rows[20_000].predicted == 1


# -- HTML


def text_of(page):
    return html.extract(html.parse(page), [])[0]


def test_main_text_without_furniture():
    page = (
        '<html><head><title>t</title><style>p{}</style><script>var x="</p>";</script></head><body><nav>menu a b</nav><header>top</header>'
        '<div class="cookie-notice">accept</div><article><h1>Head &amp; line</h1><p>One <b>two</b>&nbsp;  three<br>four<p>Five<ul><li>six<li>seven</ul>'
        '<!-- c --><form><input>name</form><div class="ad">buy</div><section id="comments"><p>first!</p></section></article>'
        '<aside>side</aside><footer>&copy; foot</footer></body></html>'
    )
    assert text_of(page) == "Head & line\nOne two three four\nFive\nsix\nseven"


def test_broken_and_odd_pages():
    assert text_of("") == "" and text_of("<div") == "" and text_of("<script>never closed") == ""
    assert text_of("just &lt;text&gt;") == "just <text>"
    assert text_of("<p>a</p></div></p><p>b") == "a\nb"
    assert text_of('<div class="main-content with-sidebar"><p>kept text here</p></div><div class="sidebar">no</div>') == "kept text here"
    assert len(text_of("<p>" + "long " * 100_000)) == 499_999


@pytest.mark.parametrize("name", ["content-with-sidebar", "layout-sidebar-right", "page-menu-open", "elementor-widget-container", "widget", "page sidebar"])
def test_wrappers_named_like_furniture_stay(name):
    assert text_of(f'<nav>home</nav><div class="{name}"><p>{"real words " * 20}</p></div><div class="ad">buy</div>') == ("real words " * 20).strip()


def test_comments_longer_than_the_text_go():
    page = f'<article><p>short text</p></article><div class="sidebar-left">aside</div><div id="comments"><article>{"mine too " * 50}</article></div>'
    assert text_of(page) == "short text"


def test_siblings_and_all_winning_paths_are_kept():
    lead, story = ("lead words " * 30).strip(), ("story words " * 50).strip()
    assert text_of(f"<body><div class=lead>{lead}</div><div class=story>{story}</div></body>") == f"{lead}\n{story}"
    page = html.parse(f"<body><div class=a>{lead}</div><div class=b>{story}</div></body>")
    assert html.extract(page, ["/body/div.b", "/body/div.a"])[0] == f"{lead}\n{story}"
    page = html.parse(f"<body><div class=a>one two three</div><div class=c>{story}</div></body>")
    assert html.extract(page, ["/body/div.a"])[0] == f"one two three\n{story}"


def test_what_holds_the_text_is_no_furniture():
    story = ("real words " * 60).strip()
    for page in (
        f'<body><form id="aspnetForm"><nav>menu</nav><div class="content"><p>{story}</p></div><input></form><footer>foot</footer></body>',
        f"<body><header><div>{story}</div></header><footer>foot</footer></body>",
        f'<body><div role="dialog"><p>{story}</p></div></body>',
        f'<body style="display:none"><p>{story}</p></body>',
    ):
        assert text_of(page) == story
    lead = ("lead words " * 20).strip()
    assert text_of(f"<header>site name</header><article><header><h1>Title</h1><p>{lead}</p></header><p>{story}</p><form>your mail <input></form></article>") == f"Title\n{lead}\n{story}"
    assert text_of(f'<article><p>{story}</p><div hidden>not seen</div><div role="alert">careful</div></article>') == story


def test_a_host_leaves_out_its_template_but_no_story(spark):
    """Brute force: of each page the containers with a winning path and those that few pages of the host have."""
    teaser, story = ("teaser words " * 30).strip(), ("story words " * 75).strip()
    usual = lambda k: f"<body><div class='teaser'><p>{teaser} {k}</p></div><div class='strip'><p>{'also read this ' * (3 if k % 2 else 1)}</p></div></body>"
    rare = f"<body><div class='teaser'><p>{teaser} x</p></div><div class='strip'><p>also read this</p></div><div class='story'><p>{story}</p></div></body>"
    pages = [(k, "http://b.example/", usual(k)) for k in range(8)] + [(8, "http://b.example/", rare)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[8] == f"{teaser} x\n{story}"
    won, seen = Counter(), Counter()
    for _, _, h in pages:
        path, held = html.voted(html.parse(h))
        won[path] += 1
        seen.update(held)
    best = sorted(won, key=lambda p: (-won[p], p))[:3]
    best = [p for p in best if won[p] * 4 >= max(won.values())]
    template = sorted(p for p in seen if seen[p] * 2 >= len(pages) and p not in best)
    assert got == {k: html.extract(html.parse(h), best, template)[0] for k, _, h in pages}


def test_ties_of_votes_go_to_the_smaller_path(spark):
    story = ("real words " * 20).strip()
    pages = [(k, "http://c.example/", f"<body><div class='{'abcd'[k]}'><p>{story}</p></div></body>") for k in range(4)]
    rows = {r.page_id: (r.text, r.path) for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {k: t for k, (t, _) in rows.items()} == dict.fromkeys(range(4), story)  # the fourth has no winner and is taken by itself


def test_hosts_agree_on_a_path(spark):
    body = lambda k: f"<div class='wrap'><div class='story b{k}'><p>{'real words ' * 20}{k}</p></div><div class='teaser'><p>{'short ' * (2 + 40 * (k == 3))}</p></div></div>"
    pages = [(k, f"http://a.example/{k}", body(k), "x") for k in range(6)] + [(None, None, None, "x"), (9, "odd url", "", "y"), (9, "odd url", "", "y")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    rows = html.main_text(df).collect()
    assert len(rows) == 9
    for r in rows:
        if r.page_id is not None and r.page_id < 6:
            assert r.text == f"{'real words ' * 20}{r.page_id}" and r.n_chars == len(r.text)
        else:
            assert (r.text, r.n_chars) == ("", 0)
    assert html.main_text(df.where("false")).collect() == []
