"""Operators across rows: near-duplicates, passages, mixing, archives, neighbours, and the pipeline, on small inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tallycart.llm import components, minhash, mixing, neighbours, passages, pii, registry, toxicity, warc
from tallycart.session import staged

SF = "/root/testdata/sf0.001"


def words(rng, n, alphabet="abcdefgh"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def edited(rng, given, share):
    return [w if rng.random() > share else rng.choice(["new", "other", "word"]) + str(rng.randint(0, 99)) for w in given]


# -- components


def test_components_of_chains_stars_and_pairs(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    links = [*chain, *((7, k) for k in range(200, 260)), (5, 3), (3, 5), (9, 9)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys([7, *range(200, 260)], 7), 3: 3, 5: 3}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


# -- near-duplicates


def brute_groups(docs, percent=85):
    sets = {}
    for k, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {k: k for k in sets}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {k: (len(sets[k]), top(k)) for k in sets}


def near_corpus():
    rng = random.Random(11)
    docs = []
    for _ in range(12):
        base = words(rng, rng.randint(20, 200))
        for share in [0.0, 0.0, 0.005, 0.01, 0.02, 0.03, 0.05][: rng.randint(1, 7)]:
            docs.append(" ".join(edited(rng, base, share)))
    drift = words(rng, 300)  # a chain: each text is near the one before only
    for k in range(12):
        drift = drift[:]
        drift[k * 20] = f"step{k}"
        drift[k * 20 + 9] = f"more{k}"
        docs.append(" ".join(drift))
    shared = words(rng, 40)
    docs += [" ".join([*shared, *words(rng, rng.randint(5, 30))]) for _ in range(25)]
    docs += ["A b", "a B", "a b c d e", "a  b\tc d e", "", "   ", "é É", "one"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_groups_equal_all_pairs(spark):
    docs = near_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {k: (n, c, c == k) for k, (n, c) in brute_groups(docs).items()}


def test_hot_group_stays_whole(spark):
    """Many near copies of one text whose first ids are mutually unlike: members must meet beyond their leaders."""
    rng = random.Random(12)
    base = words(rng, 150)
    docs = [(k, " ".join(edited(rng, base, 0.012))) for k in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == {k: c for k, (_, c) in brute_groups(docs).items()}


def test_second_round_holds_a_document_once_for_each_tuple(spark, monkeypatch):
    """Near copies on both sides of the limit share runs in most tables; what meets again must not grow with the tables."""
    rng, packed, met = random.Random(13), [], minhash.met
    base = words(rng, 150)
    docs = [(k, " ".join(edited(rng, base, 0.016))) for k in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(minhash, "met", lambda packs, settings: packed.append(packs) or met(packs, settings))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, settings=minhash.Settings(block=16)).collect()}
    assert got == {k: c for k, (_, c) in brute_groups(docs).items()}
    members = packed[0].selectExpr("sum(size(members))").first()[0]
    assert len(docs) < members <= minhash.Settings().side * len(docs)


def test_joins_of_the_second_round_meet_families_not_entries(spark, monkeypatch):
    """Near copies around the limit fill most tables; no join may put out a row for each of a document's entries there."""
    rng, joined, written = random.Random(13), [], {}
    kind, join, stage = type(spark.range(0)), type(spark.range(0)).join, minhash.staged
    base = words(rng, 150)
    docs = [(k, " ".join(edited(rng, base, 0.016))) for k in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(minhash, "staged", lambda frame, name: written.setdefault(name, stage(frame, name)))
    monkeypatch.setattr(kind, "join", lambda x, *given: joined.append(join(x, *given)) or joined[-1])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, settings=corpus_pipeline.NEAR).collect()}
    assert got == {k: c for k, (_, c) in brute_groups(docs, corpus_pipeline.NEAR.percent).items()}
    entries = written["buckets"].count()
    most = max(x.count() for x in joined if {"slot", "tuple"} & {*x.columns})
    assert entries > 40 * len(docs) and most < entries / 2


def test_near_duplicates_odd_rows(spark):
    long_text = " ".join(str(k) for k in range(40_000))
    rows = [(1, None), (2, ""), (None, "x y z"), (None, "x y z"), (3, "x y z"), (4, "x y z"), (4, "x y z"), (5, long_text), (6, long_text + " end")]
    df = spark.createDataFrame([(a, b, "c", True) for a, b in rows], "doc_id long, text string, component_id string, kept boolean")
    out = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    n = 39_996
    assert out == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1, (None, 1, None, True): 2, (3, 1, 3, True): 1, (4, 1, 3, False): 2, (5, n, 5, True): 1, (6, n + 1, 5, False): 1})
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 2: 1, None: 2, 3: 1, 5: 1})
    assert minhash.near_duplicates(df.where("false")).collect() == []


# -- passages


def brute_passages(docs, length=50):
    first = {}
    for k, text in sorted(docs, key=lambda d: d[0]):
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], k)
    out = {}
    for k, text in docs:
        b = (text or "").encode()
        gone, last = [False] * len(b), -1
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                gone[max(i, last) : i + length] = [True] * (i + length - max(i, last))
                last = i + length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "aé€😀b "])
def test_passages_equal_brute_force(spark, alphabet):
    rng = random.Random(alphabet)
    some = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    seen = [some(rng.randint(30, 120)) for _ in range(25)] + ["a" * 300, "ab" * 100]
    docs = [(k * 7 % 90, "".join(rng.choice(seen) if rng.random() < 0.6 else some(rng.randint(0, 80)) for _ in range(rng.randint(0, 5)))) for k in range(90)]
    docs[7], docs[20], docs[30] = (docs[7][0], docs[9][1]), (docs[20][0], docs[9][1]), (docs[30][0], None)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = passages.removed_passages(df, settings=passages.Settings(part=2000, range=1500, step=700)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute_passages(docs)


def test_passages_odd_rows(spark):
    text = "0123456789" * 6
    rows = [(2, text), (1, text + "!"), (None, text), (2, text), (5, "short"), (6, None), (7, text[:50]), (8, text[:49]), (9, "x" * 300_000)]
    df = spark.createDataFrame([(a, b, "c") for a, b in rows], "doc_id long, text string, code string")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in passages.removed_passages(df).collect())
    assert got == Counter([(2, 60, 60, 1), (1, 61, 0, 0), (None, 60, 0, 0), (2, 60, 60, 1), (5, 5, 0, 0), (6, 0, 0, 0), (7, 50, 50, 1), (8, 49, 0, 0), (9, 300_000, 0, 0)])
    assert passages.removed_passages(df.where("false")).collect() == []


# -- mixing


def test_mixing_follows_rates_and_repeats_itself(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "'0123456789' AS text", "CASE WHEN id < 600 THEN 'small' WHEN id < 660 THEN NULL ELSE 'big' END AS source")
    mix = mixing.Mix(weights={"small": 0.5, "big": 0.3, None: 0.2})
    rows = mixing.drawn_copies(docs, mix).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.drawn_copies(docs.repartition(7), mix).collect()))
    assert [r.place for r in rows] == sorted(r.place for r in rows)
    counts = Counter(r.source for r in rows)
    for source, weight in mix.weights.items():
        wanted = weight * 6000
        assert abs(counts[source] - wanted) < 5 * wanted**0.5
    per_doc = Counter(Counter(r.doc_id for r in rows if r.source == "small").values())
    assert abs(per_doc[5] / 600 - 0.1755) < 0.06  # Poisson with mean 5


def test_mixing_odd_rows(spark):
    rows = [(None, None, None), (None, "a", "s"), (1, "", "s"), (1, "", "s"), (2, None, "t"), (3, "x" * 50_000, "huge")]
    df = spark.createDataFrame([(a, b, c, 1, 2.0) for a, b, c in rows], "doc_id long, text string, source string, copy int, rate double")
    out = mixing.mixed_documents(df, mixing.Mix(epochs=40.0))
    assert out.columns == df.columns and out.count() > 0
    assert mixing.mixed_documents(df, mixing.Mix(weights={})).collect() == []
    assert mixing.drawn_copies(df.where("false")).collect() == []


# -- archives


def test_archives_round_trip(spark):
    rng = random.Random(13)
    bodies = ["".join(rng.choice("abé<\r\n >") for _ in range(n)) for n in (0, 10, 999, 1000, 1500, 4000)] + [None, "\r\n\r\n" * 300]
    pages = [(k, f"http://{rng.choice('abc')}.example.org:80/p{rng.randint(0, 9)}?q={k % 3}#f", rng.choice(bodies), "w") for k in range(300)]
    pages += [(900, None, "x y", "w"), (901, "no scheme", bodies[4], "w"), (None, "http://z/", bodies[4], "w"), (902, "http://a b/\n", bodies[5], "w")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest string").repartition(4)
    rows = warc.archived(df, settings=warc.Settings(archive_bytes=20_000, block=17)).collect()
    last = {}
    for k, _, html, _ in pages:
        if k is not None:
            last[html or ""] = max(last.get(html or "", -1), k)
    want = Counter()
    for k, _, html, _ in pages:
        b = (html or "").encode()
        again = len(b) >= 1000 and k is not None and last[html] != k
        want[k, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[html] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    assert warc.archived(df.where("false")).collect() == []


def test_lookup_by_url_finds_every_capture(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h{k % 7}.org/{k % 5}", "t" * k) for k in range(200)], "page_id long, url string, html string")
    s = warc.Settings(archive_bytes=3000, block=4)
    captures = warc.write_archives(warc.with_revisits(pages, s), f"{tmp_path}/a", s)
    parts = [tuple(r) for r in warc.write_index(captures, f"{tmp_path}/i", s).select("index", "first", "offset", "length").collect()]
    lookup = warc.Lookup(f"{tmp_path}/a", f"{tmp_path}/i", parts)
    for k in range(35):
        found = list(lookup.captures(warc.url_key(f"https://h{k % 7}.org/{k % 5}")))
        ids = {lookup.record(*c)["fields"]["warc-record-id"] for c in found}
        assert ids == {f"<urn:page:{x}>" for x in range(200) if x % 7 == k % 7 and x % 5 == k % 5}
    assert list(lookup.captures("org,none)/")) == [] and list(lookup.captures("")) == [] and list(lookup.captures("zz")) == []


# -- neighbours


def exact(table, every, k=10):
    out = {}
    for q, v in table:
        if q % every == 0:
            d = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in table if i != q)
            out[q] = d[:k]
    return out


def test_recall_on_clusters_and_ties(spark):
    rng = np.random.default_rng(14)
    centres = rng.normal(size=(30, 16))
    table = [(k, (centres[k % 30] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for k in range(3000)]
    table += [(k, [1.0] + [0.0] * 15) for k in range(3000, 3400)]  # one vector many times
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    s = neighbours.Settings(sample=1500, list_size=60)
    want = exact([(k, [float(np.float32(x)) for x in v]) for k, v in table], 50)
    got = {}
    for r in neighbours.nearest(df, every=50, settings=s).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in want[q]} & {i for *_, i in got[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, found in got.items():
        ranked = sorted(found)
        assert [r for r, *_ in ranked] == list(range(1, len(found) + 1))
        assert [x[1:] for x in ranked] == sorted(x[1:] for x in ranked)
    assert [i for _, i in want[3000]] == [i for *_, i in sorted(got[3000])]


def test_few_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [float("inf"), 0.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0])]
    df = spark.createDataFrame([(a, b, 1, 0.5) for a, b in rows], "vec_id long, embedding array<float>, label int, score double")
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(df, every=8).collect())
    assert found == [(0, 1, 8, 0.0), (0, 2, 1, 1.414214), (8, 1, 0, 0.0), (8, 2, 1, 1.414214)]
    assert neighbours.nearest(df.where("false")).collect() == []


# -- pipeline and registry


def test_pipeline_equals_its_stages_in_plain_python(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.toxic_scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()
    left = [(k, docs[k].text) for k in (r.doc_id for r in scored if r.score < 0.5)]
    left = [(k, t) for k, t in left for groups in [brute_groups_cached(left)] if groups[k][1] == k]
    frame = spark.createDataFrame(left, "doc_id long, text string")
    model = pii.trained(pii.sample_windows(frame, "text", pii.Settings().windows), pii.Settings())
    clean = []
    for k, text in left:
        base = pii.base_spans(text or "")
        spans = [(kind, a, b) for kind in pii.KINDS for a, b in base[kind]] + model.added(text or "", base)
        clean.append((k, pii.masked(text, pii.listed(spans)), docs[k].source))
    con = duckdb.connect()
    con.execute("CREATE TABLE clean (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO clean VALUES (?, ?, ?)", clean)
    drawn = con.execute(mixing.oracle("clean")).fetchall()
    texts = {k: t for k, t, _ in clean}
    from tallycart.llm.bpe import Encoder

    encoder = Encoder(corpus_pipeline.RANKS, public_tokenizers.PATTERN)
    want = Counter()
    for row in drawn:
        (found, _), = encoder.encoded([texts[row[0]] or ""])
        want[row[0], ",".join(w[0] for w in found)] += 1
    got = Counter((r.doc_id, ",".join(map(str, r.ids))) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_stage_joins_texts_from_four_fifths(spark):
    """Pairs of similarity 0.80 to 0.85 are one document to the stage and two to the query."""
    rng = random.Random(15)
    docs = []
    for k in range(40):
        base = words(rng, 54)  # one changed word leaves 45 of 55 shingles
        docs += [(3 * k, " ".join(base)), (3 * k + 1, " ".join([*base[:49], f"x{k}", *base[50:]]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    near = {k for k, (_, c) in brute_groups(docs, 80).items() if k == c}
    assert len(near) == 40 and len({c for _, c in brute_groups(docs, 85).values()}) == 80
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, SF).collect()} == near


_groups = {}


def brute_groups_cached(docs):
    if not _groups:
        _groups.update(brute_groups(docs, corpus_pipeline.NEAR.percent))
    return _groups


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect() == []


def test_odd_rows_go_through_all_stages(spark):
    """Nulls in any column, empty and very long texts, repeated ids and rows, tied copies."""
    text = "plain words of a clean text that says little, mail me at jane.roe@mail.example or not, as you like it best today"
    rows = [
        (1, text, "en", "a", 9), (1, text, "en", "a", 9), (1, "another text of the same id", None, "a", None), (2, text, "en", None, 1),
        (3, None, None, None, None), (4, "", "en", "b", 0), (None, text + " once more", "en", "b", 1), (None, None, None, "b", 1),
        (5, "long words " * 60_000, "en", "c", 1), (6, "\U0001f600 \u0000 odd \n\n", "xx", "c", -5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect()]
            assert len([k for k in ids if k is not None]) == len({k for k in ids if k is not None}) and 2 not in ids and {3, 4, 5, 6} <= set(ids)
        if name == "personal_data":
            assert all("jane.roe@mail.example" not in (r.text or "") for r in docs.collect())
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(str(corpus_pipeline.RANKS)), special_tokens={})
    got = Counter((r.doc_id, reference.decode(list(r.ids))) for r in corpus_pipeline.encoding(spark, docs, SF).collect())
    assert got == texts


def test_registry_names():
    assert sorted(int(re.match(r"op(\d+)_", name).group(1)) for name in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)
