"""Training-data operators against brute force, round trips and the defined edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from entres.llm import cluster, decontaminate, langid, licenses, lm_score, media, minhash, pieces, quality, substring, util, warc
from entres.llm.cluster import components
from entres.llm.util import crc_mod
from entres.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) + ("." if rng.random() < 0.12 else "") for _ in range(n))


BASE = prose(120)
PASSAGE = "Start of it. " + prose(70) + " end."
TEXTS = [None, "", "   ", "\n", "one", BASE, BASE, BASE.replace(VOCAB[3], VOCAB[4], 1), prose(60) + ". " + PASSAGE, PASSAGE + " " + prose(80), "é ñ ▁ 日本 😀 tab\tend  ", prose(3000), "the " * 500, BASE]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or ""), "x") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", None, None, None, "x"), rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.mark.parametrize("kappa", [(20.0, 5.0), None])
def test_lm_score(docs, empty, kappa):
    """Every score against counts of whole n-grams, with blocks that are much smaller than the corpus."""
    rows = [(r.doc_id, (r.text or "")) for r in docs.select("doc_id", "text").collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) + [None]
    uni, bi, tri, texts = Counter(), Counter(), Counter(), 0
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            uni.update(w)
            bi.update(zip([0, *w], w))
            tri.update(zip([0, 0, *w], [0, *w], w))
            texts += 1
    n, v = sum(uni.values()), len(uni)
    learn = lambda c: crc_mod(c, 10) == 0
    got = lm_score.score_texts(docs.select("doc_id", "text"), learn, kappa=kappa, block_bytes=4000).collect()
    assert len(got) == len(rows)
    k2, k3 = got[0].kappa
    want = []
    for i, t in rows:
        w = tokens(t)
        base = [math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w]
        score = 0.0
        for a, b, x, y in zip([0, 0, *w], [0, *w], w, base):
            p, h2, h3 = 10**y, texts if b == 0 else uni[b], texts if b == 0 else bi[a, b]
            p = (bi[b, x] + k2 * p) / (h2 + k2) if h2 else p
            p = (tri[a, b, x] + k3 * p) / (h3 + k3) if h3 else p
            score += math.log10(p)
        want.append((-1 if i is None else i, len(w), sum(uni[x] > 0 for x in w), n, round(sum(base), 5), round(score, 5)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == sorted(want)
    assert lm_score.score_texts(empty.select("doc_id", "text"), learn, kappa=kappa).count() == 0


def test_lm_walk():
    """Pieces of long texts walked side by side give the scores of one walk, token by token in plain Python."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(VOCAB[:30], 900)).encode(), b"", b"one two"] + [" ".join(rng.choice(VOCAB[:30], 5)).encode() for _ in range(40)]
    g = lm_score.Grams(texts, 3)
    m = lm_score.Automaton(g, {k: g.counts(k, np.ones(len(texts), np.int64)) for k in g.keys}, len(g.doc), len(g.keys[1]), len(texts))
    taken, stood = m.traverse()
    weight, down = m.weights((30.0, 4.0))
    arcs = dict(zip(m.arc_key.tolist(), m.arc.tolist()))
    width = len(g.keys[1]) + 1
    state = None
    for i in range(len(g.doc)):
        if g.place[i] == 0:
            state = m.known[m.start[2]]
        assert stood[i] == state
        s, paid = int(state), 0.0
        while s * width + g.inverse[1][i] not in arcs:
            f = int(m.known[m.fail[s]])
            paid += down[s] - down[f]
            s = f
        arc = arcs[s * width + g.inverse[1][i]]
        assert arc == taken[i] and abs(paid - (down[stood[i]] - down[m.state[arc]])) < 1e-9
        state = m.known[m.target[arc]]


def test_lm_keys():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 50), (1, 50), (5, 64), (5000, 47), (300, 40)):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64) >> np.uint64(62 - min(bits, 62)))
        assert (lm_score.unpack_keys(lm_score.pack_keys(keys)) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 10**9])
    assert (lm_score.unpack(lm_score.pack(counts), 6) == counts).all()


def test_media(docs, empty):
    got = media.fingerprint(media.encode_wav(docs)).collect()
    assert len(got) == docs.count()
    by_text = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = by_text[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert media.unwav(media.wav(payload)) == payload and r.media_bytes == len(media.wav(payload))
    assert by_text[5].feature == by_text[6].feature != by_text[11].feature
    assert media.fingerprints([media.pad(b"abc" * 900)])[0].tolist() == media.fingerprints([media.pad(b"x"), media.pad(b"abc" * 900)])[1].tolist()
    assert media.fingerprint(media.encode_wav(empty)).count() == 0


def slow_fingerprint(payload):
    """Peaks and pairs by the definition, with a plain Fourier sum."""
    n, bins = media.FRAME, media.FRAME // 2 + 1
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / n) for i in range(n)]
    power = []
    for at in range(0, len(payload) - n + 1, media.HOP):
        x = [(payload[at + i] - 128.0) * window[i] for i in range(n)]
        z = [sum(v * complex(math.cos(2 * math.pi * k * i / n), -math.sin(2 * math.pi * k * i / n)) for i, v in enumerate(x)) for k in range(bins)]
        power.append([0] + [round(64.0 * math.log2(1.0 + abs(c) ** 2)) for c in z[1:]])
    peaks = []
    for t, row in enumerate(power):
        ok = [k for k in range(1, bins - 1) if row[k] > row[k - 1] and row[k] >= row[k + 1] and (t == 0 or row[k] > power[t - 1][k]) and (t + 1 == len(power) or row[k] >= power[t + 1][k])]
        peaks.append(sorted(ok, key=lambda k: (-row[k], k))[: media.PEAKS])
    out = []
    for t, row in enumerate(peaks):
        later = [(u, k) for u in range(t + 1, min(t + media.REACH, len(peaks) - 1) + 1) for k in peaks[u]]
        out += [(t << 32) | (f << 20) | (k << 8) | (u - t) for f in row for u, k in later[: media.FAN]]
    return out


def test_fingerprint():
    payloads = [media.pad(prose(90).encode()), media.pad(b""), media.pad(bytes(range(256)) * 5)]
    for p, x in zip(payloads, media.fingerprints(payloads)):
        assert x.tolist() == slow_fingerprint(p)


def test_warc(spark):
    rows = [(3, "http://a/x y", "same"), (1, "http://b", "same"), (2, None, None), (7, "u", ""), (9, "u", "WARC/1.1\r\n\r\nURL 1 2\n"), (9, "u", "other"), (None, "n", "same"), (None, "n", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.read_arc(warc.pages_to_arc(pages))
    assert records.count() == len(rows)
    got = warc.read_warc(warc.write_warc(warc.mark_revisits(records))).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in got) == sorted(
        [("3", "revisit", "1", 4), ("1", "response", "None", 4), ("2", "response", "None", 0), ("7", "revisit", "2", 0), ("9", "response", "None", 20), ("9", "response", "None", 5), ("None", "revisit", "1", 4), ("None", "response", "None", 5)]
    )
    for version in (1, 2):
        body = {"url": "u", "ip": "1.1.1.1", "date": "20010203040506", "type": "text/html", "payload": b"\n\nx\n", "http": b"HTTP/1.0 200 OK\r\n\r\n"}
        parsed = list(warc.parse_arc(warc.write_arc([body, body], version, "f.arc")))
        assert [p["body"] for p in parsed] == [body["http"] + body["payload"]] * 2 and parsed[0]["version"] == version
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.write_arc([body], 1, "f")[:-6]))
    assert warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert warc.read_warc(warc.write_warc(warc.mark_revisits(warc.read_arc(warc.pages_to_arc(pages.limit(0)))))).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1), (12, 0), (11, 1), (4, None), (9, 0), (9, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.predict(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.predict(empty, quality.train([])).count() == 0
    held = QUERIES["op4_quality_classifier"](spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()


def test_quality_scores():
    """Folded weights give the softmax of the averaged vectors."""
    rng = random.Random(6)
    texts = [(prose(30, rng) if i % 2 else "buy now " * rng.randint(3, 9)).encode() for i in range(40)]
    samples = []
    for i in range(len(texts)):
        parts = [(b, np.full(len(b), 1.0 / max(1, len(b)))) for _, b in quality.features([texts[i]])]
        samples.append((np.concatenate([b for b, _ in parts]), np.concatenate([w for _, w in parts]).astype(np.float32), i % 2))
    vectors, out, bias = quality.learn(samples)
    folded, add = quality.train(samples)
    for i, p in enumerate(quality.scores(texts, folded, add)):
        z = samples[i][1] @ vectors[samples[i][0]] @ out + bias
        assert abs(p - np.exp(z[1]) / np.exp(z).sum()) < 2e-3 and (p > 0.5) == (i % 2 == 1)


def test_langid(spark, docs, empty):
    held = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count()
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 3)) and got[5].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}
    odd = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ 12 _"), (3, "12 é")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in langid.predict(odd, langid.fit(docs)).collect()} == {1: True, 2: True, 3: False}


def test_ftrl():
    """The weights are those of the follow-the-regularised-leader sums, kept densely."""
    rng = np.random.default_rng(2)
    model = langid.Ftrl(3)
    z, n = np.zeros((langid.BUCKETS + 1, 3)), np.zeros((langid.BUCKETS + 1, 3))
    for _ in range(25):
        idx = np.sort(rng.choice(langid.BUCKETS, 6, replace=False))
        x, y = rng.random(6), int(rng.integers(3))
        full = np.zeros(langid.BUCKETS + 1)
        full[idx], full[-1] = x, 0.2
        w = np.where(np.abs(z) <= langid.L1, 0, (np.sign(z) * langid.L1 - z) / ((langid.BETA + np.sqrt(n)) / langid.ALPHA + langid.L2))
        e = np.exp(full @ w - (full @ w).max())
        g = np.outer(full, e / e.sum() - np.eye(3)[y])
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / langid.ALPHA * w
        n += g * g
        model.step(idx, x, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontaminate(spark, docs, empty):
    rng = random.Random(2)
    items = [(i, prose(rng.randint(8, 25), rng)) for i in range(12)] + [(50, "tiny"), (51, ""), (52, None)]
    texts = [prose(40, rng) for _ in range(6)]
    for i in range(6):
        item = items[i][1]
        chars = list(item)
        for _ in range(decontaminate.budget(len(item))[0] + (i == 5) * 6):
            chars[rng.randrange(1, len(chars) - 1)] = "#"
        texts.append(prose(30, rng) + " " + "".join(chars).upper().replace(" ", " \n ") + " " + prose(30, rng))
    table = spark.createDataFrame(list(enumerate(texts)) + [(99, None), (98, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(table, bench).collect()}
    fold = lambda s: " ".join(s.lower().split())
    want = {(d, i) for d, t in enumerate(texts) for i, x in items if x for x in [fold(x)] if edit_distance_in(x, fold(t)) <= (decontaminate.budget(len(x))[0] if len(x) >= decontaminate.Q else 0)}
    assert got == want and len(want) >= 5
    assert decontaminate.clean(table, bench).columns == table.columns
    assert {r.doc_id for r in decontaminate.clean(table, bench).collect()} == set(range(len(texts))) - {d for d, _ in want} | {98, 99}
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(table, bench.limit(0)).count() == 0


def shingles(t, k=5):
    w = re.findall(r"\S+", (t or "").lower())
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def test_minhash(docs, empty):
    rows = docs.select("doc_id", "text").collect()
    root = list(range(len(rows)))
    sets = [shingles(r.text) for r in rows]
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or (a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values())):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(set)
    for i in range(len(rows)):
        groups[find(i)].add(rows[i].doc_id)
    want = {min((x for x in g if x is not None), default=None): g for g in groups.values()}
    got = defaultdict(set)
    for r in minhash.classes(docs).collect():
        got[r.class_id].add(r.doc_id)
    assert dict(got) == want
    kept = minhash.stage(docs.sparkSession, docs, SF)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, want))
    assert minhash.classes(empty).count() == 0


def test_stages_keep_columns_and_tell_rows_apart(spark):
    """Extra columns with the names that the operators use, an id on several texts, texts without id."""
    names = ["score", "predicted", "copies", "kept_id", "texts", "spans", "_id", "_key", "block", "key", "label", "class_id", "done", "at"]
    c, a = prose(80), prose(80)
    rows = [(1, c), (2, a), (2, c), (None, PASSAGE + " " + prose(50)), (None, PASSAGE + " " + prose(60)), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    for stage in (quality.stage, minhash.stage, substring.stage, decontaminate.stage):
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = [(r.doc_id, r.text) for r in minhash.stage(spark, docs, SF).collect()]
    assert sorted(kept, key=str) == sorted([(1, c), (2, a), *rows[3:5], (3, None)], key=str)
    cut = [r.text or "" for r in substring.stage(spark, docs, SF).collect() if r.doc_id is None]
    assert sum(PASSAGE in t for t in cut) == 1 and min(len(t) for t in cut) < len(rows[3][1]) - 0.5 * len(PASSAGE)


def test_minhash_finds_near_copies():
    """Of edited copies that are at 0.8 or more, the bands of nearly all meet."""
    rng, met, near = random.Random(12), 0, 0
    for _ in range(150):
        words = [rng.choice(VOCAB) for _ in range(rng.randint(60, 250))]
        other = list(words)
        for _ in range(rng.randint(1, 6)):
            other[rng.randrange(len(other))] = rng.choice(VOCAB)
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        if sum((a & b).values()) < 0.8 * sum((a | b).values()):
            continue
        s = minhash.Shingles([" ".join(words).encode(), " ".join(other).encode()])
        x, y = (minhash.band_keys(minhash.signature(*minhash.multiset(s.of(i)))) for i in (0, 1))
        near += 1
        met += bool((x == y).any())
    assert near > 80 and met >= 0.95 * near


@pytest.mark.parametrize(("cell", "rounds", "thin"), [(10**6, 1, False), (200, 1, True), (300, 2, False), (10**6, 2, True)])
def test_cluster_links_all_similar_pairs_of_a_band(spark, cell, rounds, thin):
    rng = random.Random(1)
    sets = {}
    for _ in range(6):
        base = [rng.getrandbits(62) for _ in range(30)]
        for _ in range(20):
            x = list(base)
            for _ in range(rng.randint(0, 7)):
                x[rng.randrange(30)] = rng.getrandbits(62)
            sets[rng.randrange(-(2**62), 2**62)] = set(x)
    bands = [(k, rng.randrange(4) + 10 * b) for k in sets for b in range(3)]
    root = {k: k for k in sets}
    find = lambda k: k if root[k] == k else find(root[k])
    for a, i in bands:
        for b, j in bands:
            if i == j and a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    elems = spark.createDataFrame([(k, np.array(sorted(x), np.uint64).tobytes()) for k, x in sets.items()], "key long, elems binary")
    got = {r.key: r.root for r in cluster.classes(spark.createDataFrame(bands, "key long, band long"), lambda sieve: elems, 0.8, "t", cell, rounds, thin=thin).collect()}
    group = lambda of: {frozenset(k for k in sets if of(k) == r) for r in map(of, sets)}
    assert group(find) == group(lambda k: got.get(k, k))


def test_bagminhash_is_unbiased():
    rng = np.random.default_rng(0)
    z = []
    for _ in range(30):
        n = int(rng.integers(3, 150))
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        a = rng.integers(1, 9, n)
        b = np.maximum(1, a + rng.integers(-2, 3, n))
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        z.append(((minhash.signature(keys, a, 1024) == minhash.signature(keys, b, 1024)).mean() - j) / math.sqrt(max(j * (1 - j), 1e-4) / 1024))
    assert abs(np.mean(z)) < 0.8 and np.std(z) < 1.6


def test_lm_levels_are_shared():
    """The weights of kappas with the same beginning come from one level, and are those of the definition."""
    g = lm_score.Grams([b"a b a b c", b"b a c a b"], 3)
    total = {k: g.counts(k, np.ones(2, np.int64)) for k in g.keys}
    m = lm_score.Automaton(g, total, 12, 4, 2)
    for kappa in lm_score._grid(3):
        weight, down = m.weights(kappa)
        for i in range(len(weight)):
            k, c, h = int(m.level[i]), int(m.count[i]), int(m.context[m.state[i]])
            p = (c + 0.1) / (12 + 0.1 * 5) if k == 1 else (c + kappa[k - 2] * 10 ** weight[m.lower[i]]) / (h + kappa[k - 2])
            assert abs(10 ** weight[i] - p) < 1e-12
        for s in np.flatnonzero(m.depth > 0):
            x, h = kappa[m.depth[s] - 1], m.context[s]
            assert abs(down[s] - (math.log10(x / (h + x)) if h else 0.0) - down[m.fail[s]]) < 1e-12
    assert sorted(m.memo) == [(), *[(x,) for x in lm_score.GRID[0]]]


def test_central_groups(spark):
    """Copies of one text that are far from each other: the text is the centre wherever it is, so each copy has one star to go to."""
    rng = random.Random(5)
    text = 1000  # not the smallest key
    bands = [(text, b) for b in range(32)]
    for key in range(1, 200):
        bands += [(key, b if rng.random() < 0.4 else 1000 * key + b) for b in range(32)]
    with_text = {b for k, b in bands if k != text and b < 32}
    rows = cluster.groups(spark.createDataFrame(bands, "key long, band long"), True).collect()
    assert {(r.key, r.band) for r in rows} == {(k, b) for k, b in bands if b < 32 and b in with_text}
    assert {r.centre for r in rows} == {text}


def test_open_items_stand_once_in_the_home_of_a_centre(spark, monkeypatch):
    """Items that are between near and far of the same centre in many bands are dealt to be compared once, not once a band."""
    rng = random.Random(12)
    base = [rng.getrandbits(62) for _ in range(30)]
    sets = {1: set(base)}
    for k in range(2, 40):
        x = list(base)
        for i in rng.sample(range(30), 2 if k % 2 else 5):
            x[i] = rng.getrandbits(62)
        sets[k] = set(x)
    cells, real = [], cluster.compared
    monkeypatch.setattr(cluster, "compared", lambda c, *a: cells.append([(r.home, r.key) for r in c.collect()]) or real(c, *a))
    bands = spark.createDataFrame([(k, b) for k in sets for b in range(16)], "key long, band long")
    elems = spark.createDataFrame([(k, np.array(sorted(x), np.uint64).tobytes()) for k, x in sets.items()], "key long, elems binary")
    cluster.classes(bands, lambda sieve: elems, 0.8, "t", 10**6, 1, thin=True).collect()
    centres = [x for x in cells[0] if x[0] not in range(16)]  # other homes are bands
    assert len(centres) == len(set(centres)) == len(sets)


def test_components(spark):
    rng = random.Random(4)
    ids = [rng.randrange(-(2**62), 2**62) for _ in range(300)]
    edges = [(ids[i], ids[i + 1]) for i in range(120)] + [(rng.choice(ids[150:]), rng.choice(ids[150:])) for _ in range(90)]
    got = {r.key: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(got[a] == got[b] for a, b in edges if a != b)
    assert len({got[x] for x in ids[:121]}) == 1 and got[ids[0]] not in {got[x] for x in ids[150:] if x in got}


def test_substring(docs, empty):
    spans = {r.doc_id: r.spans for r in substring.repeats(docs).collect()}
    assert 9 in spans and 8 not in spans and 11 not in spans and 6 in spans and 5 not in spans
    assert spans[9][0].kept_in == 8
    cut = {r.doc_id: r for r in substring.stage(docs.sparkSession, docs, SF).collect()}
    assert cut[8].text == TEXTS[8] and cut[0].text is None and cut[11].text == TEXTS[11]
    assert len(cut[9].text) < len(TEXTS[9]) - 0.5 * len(PASSAGE) and cut[9].n_chars == len(cut[9].text)
    assert substring.stage(docs.sparkSession, docs, SF).count() == docs.count()
    assert substring.repeats(empty).count() == 0


def slow_spans(rows):
    """Spans to cut by the definition: winnowed paragraphs, all pairs, components; rows are (id, text), distinct."""
    words, starts, sets = [], [], []
    for d, (_, t) in enumerate(rows):
        w = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^ \t-\r]+", t or "")]
        hashes = minhash.Shingles([(t or "").encode()]).run
        words.append(w)
        able = len(w) - substring.MIN_WORDS + 1
        if able <= 0:
            continue
        opens = [i == 0 or w[i - 1][0][-1] in ".!?" or "\n" in t[w[i - 1][2] : w[i][1]] for i in range(len(w))]
        mark = [(not opens[i], int(hashes[i]) >> 1) for i in range(able)]
        width = min(substring.WINNOW, able)
        chosen = {i for lo in range(able - width + 1) for least in [min(mark[lo : lo + width])] for i in range(lo, lo + width) if mark[i] == least}
        for i in sorted(chosen):
            starts.append((d, i))
            x = [a for a, _, _ in w[i : i + substring.MIN_WORDS]]
            sets.append({tuple(x[j : j + 5]) for j in range(len(x) - 4)})
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for r in {find(i) for i in range(len(sets))}:
        group = [starts[i] for i in range(len(sets)) if find(i) == r]
        first = min(d for d, _ in group)  # rows are in order
        for d, i in group:
            if d != first:
                out[d].append((words[d][i][1], words[d][i + substring.MIN_WORDS - 1][2]))
    joined = {}
    for d, spans in out.items():
        joined[d] = []
        for a, b in sorted(spans):
            if joined[d] and a <= joined[d][-1][1]:
                joined[d][-1] = (joined[d][-1][0], max(b, joined[d][-1][1]))
            else:
                joined[d].append((a, b))
    return joined


def test_substring_against_all_pairs(spark):
    rng = random.Random(21)
    passages = [prose(rng.randint(52, 90), rng) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [prose(rng.randint(5, 60), rng)]
        for p in rng.sample(passages, rng.randint(0, 2)):
            w = p.split()
            if rng.random() < 0.3:
                w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w), prose(rng.randint(5, 60), rng)]
        rows.append((i, " ".join(parts) if i % 3 else "\n".join(parts)))
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = slow_spans(rows)
    assert got == want and len(want) >= 10
    # nothing of more than 50 words is left in two documents
    left = {r.doc_id: re.findall(r"\S+", r.text.lower()) for r in substring.cut(spark.createDataFrame(rows, "doc_id long, text string"), substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    runs = defaultdict(set)
    for d, w in left.items():
        for i in range(len(w) - 50):
            runs[tuple(w[i : i + 51])].add(d)
    assert not [r for r, d in runs.items() if len(d) > 1]


def test_quality_score_is_of_the_text_alone():
    """Which texts share a slice changes no score."""
    rng = random.Random(3)
    texts = [prose(rng.randint(1, 40), rng).encode() for _ in range(30)] + [b"", b" a"]
    folded = np.random.default_rng(1).normal(size=2 * quality.BUCKETS)
    alone = np.concatenate([quality.scores([t], folded, 0.1) for t in texts])
    assert np.allclose(quality.scores(texts, folded, 0.1), alone, rtol=0, atol=1e-9)


def test_scratch_tables_are_written_in_small_batches(spark):
    """Batches of whole texts stay small while a scratch table is written, and the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def count(batches):
        for b in batches:
            yield pa.record_batch({"n": [b.num_rows]})

    found = util.write_scratch(spark.range(0, 9000, 1, 1).mapInArrow(count, "n long"), "batches")
    assert found.agg({"n": "max"}).first()[0] <= util.BATCH_ROWS and found.agg({"n": "sum"}).first()[0] == 9000
    assert spark.conf.get(key) == before


def whole_runs(rows, least=51):
    """(document, word) of every word in a run of ``least`` words that an earlier document has, by comparing all runs."""
    first, gone = {}, set()
    for d, t in rows:
        w = re.findall(r"\S+", (t or "").lower())
        for i in range(len(w) - least + 1):
            if first.setdefault(tuple(w[i : i + least]), d) != d:
                gone |= {(d, j) for j in range(i, i + least)}
    return gone


@pytest.mark.parametrize("many", [substring.PLACES, 2])
def test_passages_are_cut_to_their_last_word(spark, many):
    """No word of a repeated run of 51 words stays but in its first document, whichever documents share it, whether occurrences are compared in tasks or by hashes."""
    rng = random.Random(31)
    passages = [prose(rng.randint(51, 200), rng) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [prose(rng.randint(0, 60), rng)]
        for p in rng.sample(passages, rng.randint(0, 2)):
            w = p.split()
            a = rng.randint(0, len(w) - 51)  # documents share parts of a passage, not all with the first
            parts += [" ".join(w[a : rng.randint(a + 51, len(w))]), prose(rng.randint(0, 60), rng)]
        rows.append((i, (" " if i % 3 else "\n").join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in substring.passages(docs, many=many).collect():
        at = [(m.start(), m.end()) for m in re.finditer(r"\S+", rows[r.doc_id][1])]
        got |= {(r.doc_id, i): s.kept_in for s in r.spans for i, (a, b) in enumerate(at) if s.start <= a and b <= s.end}
    want = whole_runs(rows)
    assert len(want) > 1000 and not want - set(got)
    # besides similar paragraphs, words go only where an earlier document has them next to the same words
    seeds = {(d, i) for d, spans in slow_spans(rows).items() for i, m in enumerate(re.finditer(r"\S+", rows[d][1])) if any(a <= m.start() and m.end() <= b for a, b in spans)}
    assert want - seeds and all(kept < d for (d, _), kept in got.items()) and not set(got) - seeds - whole_runs(rows, 21)


def test_equal_surroundings_are_not_compared():
    """A passage that all documents have alike sends no words but those at its ends, and a line that a document repeats one row."""
    rng = random.Random(4)
    run, line = " ".join(rng.choices(VOCAB, k=400)), " ".join(rng.choices(VOCAB, k=24)) + "."
    texts = [prose(40, rng) + " " + run + " " + " ".join([line] * 50) for _ in range(5)]

    class All:
        value = type("S", (), {"has": staticmethod(lambda keys: np.ones(len(keys), bool))})

    batch = pa.record_batch({"doc_id": pa.array(range(5), pa.int64()), "text_key": pa.array(range(5), pa.int64()), "text": texts})
    facts = pa.Table.from_batches(substring._facts(All, All)([batch])).to_pandas()
    differ = [set(facts.key[(facts.doc_lo < facts.doc_hi) & (facts[f"{c}_lo"] < facts[f"{c}_hi"])]) for c in "lr"]
    several = set(facts.key[facts.doc_lo < facts.doc_hi])
    assert len(several) > 15 and len(differ[0]) <= 4 and len(differ[1]) <= 4
    sieve = lambda keys: type("B", (), {"value": type("S", (), {"has": staticmethod(lambda k: np.isin(k, list(keys)))})})
    found = pa.Table.from_batches(substring._occurrences(sieve(several), tuple(map(sieve, differ)))([batch])).to_pandas()
    assert not found[found.side == 2].duplicated(["key", "doc_id"]).any() and (found.side < 2).sum() < 5 * 12


def kept_runs(texts):
    """Whether the texts have a paragraph in common."""
    p = substring.Paragraphs([t.encode() for t in texts])
    keys = [set(p.key[p.doc == d].tolist()) for d in range(len(texts))]
    return bool(set.intersection(*keys))


def test_passages_without_sentences():
    """A pasted run of 51 words shares a paragraph at every offset, with no sentence end anywhere."""
    rng = random.Random(8)
    for k in range(200):
        run = " ".join(rng.choices(VOCAB, k=51))
        texts = [" ".join(rng.choices(VOCAB, k=k % 23)) + " " + run + " " + " ".join(rng.choices(VOCAB, k=30)) for _ in range(2)]
        texts[1] = " ".join(rng.choices(VOCAB, k=k % 7)) + " " + texts[1]
        assert kept_runs(texts)


def test_passages_of_short_sentences():
    """So does a run of lines or sentences of one to four words."""
    rng = random.Random(9)
    for k in range(200):
        ends = ("!!", ".", "\n", "?")
        run = " ".join(rng.choice(VOCAB) + (rng.choice(ends) if i % (1 + k % 4) == 0 else "") for i in range(51))
        texts = [prose(rng.randrange(40), rng) + " " + run + " " + prose(30, rng) for _ in range(2)]
        assert kept_runs(texts)


def test_licenses(spark, empty):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", prose(40)), (3, "a/b/COPYING", "Licensed under CC BY-NC 4.0."), (4, "a/b/c/y.py", prose(20)), (5, "z/q.py", None), (6, "a/h.py", prose(30) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(9)), (7, None, "")]
    got = {r.doc_id: (r.license, r.origin, r.inherited_from) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "file", None), 2: ("CC-BY-NC-4.0", "inherited", "a/b/COPYING"), 3: ("CC-BY-NC-4.0", "file", None), 4: ("CC-BY-NC-4.0", "inherited", "a/b/COPYING"), 5: (None, "none", None), 6: ("Apache-2.0", "header", None), 7: (None, "none", None)}
    assert licenses.scan(licenses.document_paths(empty)).count() == 0


def slow_cosine(text, texts, template):
    """TF-IDF cosine of two texts; words as the operator has them, frequencies counted over ``texts``."""
    bag = lambda t: Counter(x for x in (re.sub(r"^[.,;:!?()\[\]\"'*#/]{0,3}|[.,;:!?()\[\]\"'*#/]{0,3}$", "", w) for w in t.lower().split()) if x)
    sets = [set(bag(t or "")) for t in texts]
    idf = lambda w: math.log((1 + len(texts)) / (1 + sum(w in s for s in sets))) + 1
    a, b = ({w: (1 + math.log(n)) * idf(w) for w, n in bag(t).items()} for t in (text, template))
    return sum(a[w] * b[w] for w in a.keys() & b) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


def test_licenses_against_all_lines(spark):
    """Lines, and words that every text has: the best cosine over all lines and templates."""
    rng = random.Random(3)
    lines = ["Project code this is licensed under the Apache License, Version 2.0.", "released under MIT, the license of the project", "SPDX-License-Identifier: ISC", "the license the license the license is GPL", "Licensed under CC BY 4.0. by project"]
    texts = ["project code is ours\n" + prose(20, rng) for _ in range(60)] + [f"project code is ours\n{x}\n{prose(9, rng)}" for x in lines]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, f"d{i}/x.py", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")).collect()}
    short = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts if len(t.split()) <= licenses.LONG]
    for i, text in enumerate(texts):
        top = max(slow_cosine(x, texts, t) for x in text.split("\n") for _, t in short)
        if top >= licenses.THRESHOLD:
            assert abs(got[i].score - top) < 1e-9 and got[i].license
        else:
            assert got[i].license is None and got[i].score == 0
    assert sum(r.license is not None for r in got.values()) >= 3


def test_licenses_notices_over_lines(spark):
    """Notices that are wrapped as files have them, and heads of licence texts."""
    wrap = lambda t, mark="# ": "\n".join(mark + " ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9))
    wanted = {"GPL-3.0": 1, "GPL-2.0": 1, "LGPL-3.0": 1, "AGPL-3.0": 1, "Apache-2.0": 1, "MIT": 2, "BSD-3-Clause": 2, "ISC": 1, "MPL-2.0": 1, "Unlicense": 1}
    rows = [(i, f"p{i}/main.py", f"{wrap('copyright 2020 by somebody')}\n{wrap(licenses.TEMPLATES[n][k])}\n{prose(300)}") for i, (n, k) in enumerate(wanted.items())]
    rows.append((99, "z/LICENSE", "   GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n" + prose(500)))
    rows.append((100, "z/a/b.c", "int x;"))
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan(spark.createDataFrame(rows + [(200 + i, f"y{i}", prose(40)) for i in range(40)], "doc_id long, path string, text string")).collect()}
    assert [got[i][0] for i in range(len(wanted))] == list(wanted)
    assert got[99] == ("GPL-3.0", "file") and got[100] == ("GPL-3.0", "inherited") and not any(got[200 + i][0] for i in range(40))


def test_pieces(docs, empty):
    encoded = pieces.encode(docs)
    assert encoded.where("lossless").count() == docs.count()
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    with open(pieces.MODEL, "rb") as f:
        proto = f.read()
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    plain = pieces.Encoder(pieces.Vocabulary(proto), dropout=0.0)
    texts = [t for t in TEXTS if t and pieces.SPACE not in t]
    assert [x.tolist() for x in plain.encode(texts, list(range(len(texts))))] == [sp.encode(t) for t in texts]
    # every occurrence by the heap agenda, with the keys of its own place
    rng = random.Random(5)
    texts += ["a  b   c\n\nd\n e ", "x" * 60 + " y " + "é" * 30, " ".join("".join(rng.choices("abcdeé#日", k=rng.randint(1, 14))) for _ in range(300))]
    for dropout in (0.1, 0.5):
        enc = pieces.Encoder(plain.v, seed=9, dropout=dropout)
        for _ in range(2):  # the second time all states are known
            for i, (t, x) in enumerate(zip(texts, enc.encode(texts, list(range(len(texts)))))):
                units = re.findall(r" *[^ \n]+| +|\n", " " + t) if t else []
                assert x.tolist() == [p for u, k in zip(units, pieces.unit_keys(i, len(units), 9)) for p in pieces.agenda(plain.v, u, int(k), dropout)]
    often = pieces.Encoder(plain.v, dropout=0.3).encode(["international " * 300], [1])[0]
    cuts = plain.v.decode(often.tolist())
    assert cuts.decode() == "international " * 300
    units, at = set(), []
    for p in often.tolist():
        at.append(p)
        if sum(plain.v.raw_size[q] for q in at) >= len(" international"):
            units.add(tuple(at))
            at = []
    assert len(units) > 12
    assert pieces.encode(empty).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    ids = [r.doc_id for r in rows]
    assert all(r.lossless for r in rows) and 0 < len(rows) < docs.count() and len(set(ids)) == len(ids)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_states_begin_anew(monkeypatch):
    """Pieces do not depend on when the states kept by a task are dropped."""
    with open(pieces.MODEL, "rb") as f:
        v = pieces.Vocabulary(f.read())
    rng = random.Random(5)
    texts = [" ".join(["often", *("".join(rng.choices("abcdeé#", k=rng.randint(1, 9))) for _ in range(40))]) for _ in range(60)]
    want = pieces.Encoder(v).encode(texts, list(range(60)))
    monkeypatch.setattr(pieces, "STATE_BYTES", 60_000)
    small = pieces.Encoder(v)
    for i, t in enumerate(texts):
        assert small.encode([t], [i])[0].tolist() == want[i].tolist()


def test_very_long_texts(spark):
    """Texts of a megabyte, with and without white space, go through every operator whole."""
    long = ["word" + str(i % 977) for i in range(150_000)]
    rows = [(1, " ".join(long)), (2, "x" * 1_000_000), (3, " ".join(long)), (4, "é\n" * 200_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert lm_score.score_texts(docs, lambda c: crc_mod(c, 10) == 0).agg({"n_tokens": "sum"}).first()[0] == 2 * 150_001 + 2 + 200_001
    assert pieces.encode(docs).where("lossless").count() == 4
    assert media.fingerprint(media.encode_wav(docs)).count() == 4
    assert {r.doc_id: r.class_id for r in minhash.classes(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    left = substring.stage(spark, docs, SF).where("doc_id = 3").first().text.split("  ")  # up to 11 words between paragraphs stay
    assert max(len(x.split()) for x in left) <= substring.WINNOW - substring.MIN_WORDS
    assert decontaminate.clean(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 4
    assert langid.predict(docs, langid.fit(docs)).count() == 4 and licenses.scan(licenses.document_paths(docs)).count() == 4
    assert quality.predict(docs, quality.train([])).count() == 4
