"""Near copies, decontamination, language, toxicity against brute force or held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmap import session
from reachmap.llm import decontam, langid, ngram_join, toxicity

from .helpers import documents, odd_rows, rows_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def changed(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else w + "x" for w in text)


def near_rows(n=120):
    rows = []
    for i in range(n):
        base = words(40 + i % 60, i % 25, "abc")
        rows.append((i, changed(base, i, [0.0, 0.01, 0.03, 0.06][i % 4])))
    rows += [(n + 1, "A b\tc"), (n + 2, "a B c"), (n + 3, "a b"), (n + 4, " ".join("abcdefghi")), (n + 5, " ".join("abcdefghij"))]
    return rows + odd_rows()


def sets_of(rows):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    return out


def brute_components(rows):
    sets, up = sets_of(rows), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    out = []
    for group in members.values():
        low = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        out += [(rows[i][0], len(sets[i]), low) for i in group]
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "limits",
    [{}, {"chunk_shingles": 500, "range_bytes": 4096}, {"block_sets": 4, "block_shingles": 300}, {"block_sets": 2}],
)
def test_components_equal_brute_force(spark, limits):
    rows = near_rows()
    got = ngram_join.link_components(documents(spark, rows, extra=True).repartition(6), **limits)
    assert rows_of(got) == brute_components(rows)


def test_written_tables_do_not_grow_with_the_shuffle_partitions(spark, tmp_path, monkeypatch):
    """A session with many partitions must not cost a file, or a job, for each of them."""
    settings = {
        "spark.sql.shuffle.partitions": "37",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    old = {k: spark.conf.get(k, None) for k in settings}
    rows = near_rows()
    docs = documents(spark, rows, extra=True).repartition(6)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert rows_of(ngram_join.link_components(docs, block_sets=4)) == brute_components(rows)
        keys = spark.range(300).repartition(37, "id").selectExpr("xxhash64(id) as key")
        spark.sparkContext.setJobGroup("flags", "")
        flags = ngram_join._flags(keys)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("flags")) <= 3
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    low = (1 << ngram_join.FLAG_BITS) - 1
    assert set(np.flatnonzero(flags).tolist()) == {r.key & low for r in keys.collect()}
    for name in ("signatures", "sets", "leads", "low", "large", "members", "low-ids", "groups"):
        tables = list(tmp_path.glob(f"reachmap-{name}-" + "?" * 32))
        assert tables, name
        assert all(len(list(t.glob("part-*"))) == 1 for t in tables), name


def test_a_shingle_of_all_documents_reaches_its_range_once_a_chunk(spark):
    common = words(12, 7)
    rows = [(i, " ".join(common + words(30, 1000 + i // 2))) for i in range(400)]
    read = [(i, i, np.unique(np.array([hash_ * 2**40 + 1 for hash_ in (3, 5, 7, 1000 + i, 2000 + i, 3000 + i)], np.uint64))) for i in range(400)]
    for keep in (False, True):
        batches = list(ngram_join._send(3, 600, lambda b: b, keep)([read]))
        sent = [r for b in batches for r in b.to_pylist()]
        chunks = {r["chunk"] for r in sent}
        entries = sum(len(r["owner"]) // 2 for r in sent)
        assert len(chunks) == 4
        assert entries == 400 * 3 + len(chunks) * 3  # not 400 * 6
    got = ngram_join.link_components(documents(spark, rows).repartition(5), chunk_shingles=900, range_bytes=2048)
    assert rows_of(got) == brute_components(rows)


def test_divide_skip_equals_all_pairs():
    r = random.Random(3)
    for trial in range(30):
        base = [r.randrange(10**6) for _ in range(r.randint(6, 80))]
        sets = []
        for _ in range(r.randint(2, 40)):
            s = {x if r.random() > 0.06 else r.randrange(10**6) for x in base}
            s |= {r.randrange(50) for _ in range(r.randint(0, 6))}
            sets.append(np.array(sorted(s), np.uint64))
        up = list(range(len(sets)))
        for i, a in enumerate(sets):
            for j in range(i):
                k = len(np.intersect1d(a, sets[j]))
                if 100 * k >= 85 * (len(a) + len(sets[j]) - k):
                    x, y = up[i], up[j]
                    up = [min(x, y) if u in (x, y) else u for u in up]
        got = ngram_join.divide_skip(sets)
        same = lambda roots: {frozenset(np.flatnonzero(np.array(roots) == x)) for x in set(roots)}
        assert same(list(got)) == same(up)


def test_one_of_each(spark):
    rows = near_rows()
    docs = documents(spark, rows, extra=True)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(repr(r.doc_id) for r in kept.collect())
    want, seen = [], set()
    for i, n, c in brute_components(rows):
        if n == 0 or i is None or (i == c and c not in seen):
            want.append(repr(i))
        if n and i == c:
            seen.add(c)
    assert got == sorted(want)
    assert ngram_join.one_of_each(documents(spark, [])).count() == 0
    assert ngram_join.link_components(documents(spark, [])).count() == 0


def contaminated_rows():
    items = [(i, " ".join(words(8 + 3 * i, 100 + i))) for i in range(12)]
    items += [(20, "Two words"), (21, ""), (22, None), (None, " ".join(words(15, 7))), (23, items[3][1] + " more of it"), (5, items[4][1])]
    r = random.Random(1)
    rows = []
    for i in range(150):
        w = words(60, i)
        if i % 2:
            t = ALNUM.findall((items[i % 12][1]).translate(LOWER))
            a = r.randrange(len(t))
            w[20:20] = t[a : a + r.randint(5, 25)]
        rows.append((i, ("; " if i % 5 else " ").join(w).title() if i % 3 else " ".join(w)))
    return rows + odd_rows() + [(300, "x two WORDS y"), (301, items[3][1])], items


def brute_contamination(rows, items):
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add("" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                who = windows.get(tuple(w[j : j + k]))
                if who:
                    hit.update(range(j, j + k))
                    found |= who
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece_bytes", [1 << 20, 300])
def test_contamination_equals_brute_force(spark, piece_bytes):
    rows, items = contaminated_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(documents(spark, rows, extra=True), bench, piece_bytes=piece_bytes)
    assert rows_of(got, *got.columns[:6]) == brute_contamination(rows, items)
    whole = {r.doc_id: r for r in got.collect()}
    assert whole[301].longest == len(items[3][1].split()) and whole[301].longest_at == 0
    docs = documents(spark, rows, extra=True)
    kept = decontam.decontaminate(docs, bench, piece_bytes=piece_bytes)
    want = sorted(repr(r[0]) for r in brute_contamination(rows, items) if not r[5])
    assert kept.columns == docs.columns and sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_contamination_without_items_or_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(documents(spark, odd_rows()), none).filter("n_hit > 0").isEmpty()
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contamination(documents(spark, []), bench).count() == 0
    assert decontam.decontaminate(documents(spark, odd_rows()), none).count() == len(odd_rows())


ENDINGS = {"xx": ("ion", "ing", "the", "of"), "yy": ("keit", "ung", "der", "ß"), "zz": ("ción", "os", "el", "ñ")}


def language_rows(n=300):
    rows = []
    for i in range(n):
        lang = sorted(ENDINGS)[i % 3]
        r = random.Random(i)
        t = " ".join("".join(r.choice(ENDINGS[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(3, 60)))
        rows.append((i, t, lang, "s", 0))
    return rows


def test_language_of_held_out_rows(spark):
    rows = language_rows()
    odd = [(i, t, "xx" if i else None, None, None) for i, t in odd_rows()]
    got = langid.identify(documents(spark, rows + odd, extra=True)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0] + 0: r for r in rows}
    right = [r.lang_pred == truth[r.doc_id][2] for r in got if r.doc_id is not None and r.doc_id >= 10 and r.held_out]
    assert len(right) > 80 and np.mean(right) > 0.98
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    texts = {None: "und", "": "und", " \t\n": "und", "£ ½ — ☃": "und"}
    alone = langid.identify(documents(spark, [(i, t) for i, t in enumerate(texts)] + rows)).filter("doc_id < 4")
    assert {"und"} <= {r.lang_pred for r in alone.collect()}
    assert langid.with_language(documents(spark, rows + odd)).count() == len(rows) + sum(
        bool(t and any(c.isalpha() for c in t)) for _, t, *_ in odd
    )


def plain_codes(samples, text):
    """Code lengths by prediction by partial matching with dictionaries, byte by byte."""
    order = langid.MAX_ORDER
    pad = bytes([langid.START]) * order

    def contexts(data, i):
        return [data[i - k : i] for k in range(order, -1, -1)]

    seen = {}
    for t in samples:
        data = pad + t.encode()
        for i in range(order, len(data)):
            for c in contexts(data, i):
                seen.setdefault(c, {}).setdefault(data[i], 0)
                seen[c][data[i]] += 1
    bits, data = [], pad + text.encode()
    for i in range(order, len(data)):
        p, gone = 1.0, set()
        for c in contexts(data, i):
            left = {b: n for b, n in seen.get(c, {}).items() if b not in gone}
            if not left:
                continue
            whole = sum(left.values()) + (len(left) if len(left) < 256 - len(gone) else 0)
            if data[i] in left:
                p *= left[data[i]] / whole
                break
            p *= len(left) / whole
            gone |= set(left)
        else:
            p /= 256 - len(gone)
        bits.append(-np.log2(p))
    return bits


def language_model(samples):
    counts = langid._counts(__import__("pandas").DataFrame([(t, lang) for lang, ts in samples.items() for t in ts], columns=["text", "lang"]))
    return langid.build_model([tuple(r) for r in counts.itertuples(index=False)])


def test_language_codes_are_exact():
    """Probabilities of a context sum to 1 and code lengths add up byte by byte."""
    model = language_model({"a": ["banana bandana"] * 60})
    for context in {int(g) >> 8 for g in model["gram"]} | {0, 0x616263, 0x7A7A61}:
        p = np.exp2(-langid.gram_bits((context << 8) | np.arange(256), model["trees"][0])).sum()
        assert np.isclose(p, 1)
    data = np.frombuffer(b"bananaxband", np.uint8)
    whole = langid.code_lengths(data, np.array([0, 6, 6, 11]), model)
    apart = [langid.code_lengths(data[a:b], np.array([0, b - a]), model)[0, 0] for a, b in ((0, 6), (6, 11))]
    assert np.allclose(whole[:, 0], [apart[0], 0, apart[1]], atol=1e-3)


def test_language_codes_equal_plain_partial_matching():
    samples = {"a": words(60, 1, "abcd") + ["once", "ünïx \x00"], "b": words(80, 2, "bcdef"), "c": ["z"], "d": [bytes(range(128)).decode() * 3]}
    model = language_model(samples)
    assert model["langs"] == sorted(samples)
    texts = ["abcdabcd", "q", "dcba zzz ünï", "", "\n\n", "feed the bad cab 12", "zz"] + words(20, 3, "abcdefz ")
    for t in texts:
        got = langid.code_lengths(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), model)[0]
        assert np.allclose(got, [sum(plain_codes(samples[lang], t)) for lang in sorted(samples)])


def test_sample_of_a_hot_language_is_that_of_one_window(spark):
    rows = [(i, f"text {i}", "xx" if i % 5 else "yy", "s", 0) for i in range(900)]
    docs = documents(spark, rows)
    h = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id")).collect()}
    want = set()
    for lang in ("xx", "yy"):
        known = [i for i, _, g, *_ in rows if g == lang and zlib.crc32(str(i).encode()) % 3 != 1]
        want |= set(sorted(known, key=h.get)[:50])
    assert {r.doc_id for r in langid.training_rows(docs, 50).collect()} == want


def test_language_without_anything_to_learn(spark):
    got = langid.identify(documents(spark, odd_rows())).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert langid.identify(documents(spark, [])).count() == 0


def toxic_rows(n=600):
    rows, labels = [], []
    bad = ["idiot", "scum", "moronic", "moronish"]
    for i in range(n):
        r = random.Random(i)
        sentences = [" ".join(words(8, 1000 * i + k, "abcdefgh")) for k in range(6)]
        toxic = int(i % 4 == 0)
        if toxic:
            k = r.randrange(6)
            sentences[k] = f"you {r.choice(bad)} " + sentences[k] + f" {r.choice(bad)}"
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_of_held_out_rows(spark):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(labels + [(5, 1, None), (0, 0, 0), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, rows + [(10_000 + (i or 0), t) for i, t in odd_rows()], extra=True), table).collect()
    truth = {i: t for i, _, t in labels}
    held = [(r.predicted, truth[r.doc_id], r) for r in got if r.doc_id in truth and r.held_out]
    assert np.mean([p == t for p, t, _ in held]) > 0.97 and len(held) > 150
    texts = dict(rows)
    for p, t, r in held:
        if p and t:  # the worst sentence is the one with the word
            assert re.search("idiot|scum|moron", texts[r.doc_id][r.worst_at : r.worst_end])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got) and len(got) == len(rows) + len(odd_rows())
    assert not any(r.predicted for r in got if r.doc_id >= 10_000)


def test_training_and_scoring_see_the_same_features():
    r = random.Random(3)
    kinds = words(40, 2, "abcde") + ["naïve", "groß"]
    docs = [" ".join(r.choice(kinds) + r.choice(["", "", ".", "!", "\n"]) for _ in range(r.randint(0, 60))) for _ in range(40)] + ["", "..", "a a a"]
    w, bias = np.random.default_rng(1).normal(size=1 << toxicity.HASH_BITS).astype(np.float32), -1.0
    f, s, c, owner = toxicity.bags(docs)
    trained = np.bincount(s, w[f].astype(float) * c, minlength=len(owner)) + bias
    weights = toxicity.WordWeights(w)
    for i, text in enumerate(docs):
        # plain noisy-or: each sentence a sum over its different words and their beginnings
        plain = []
        for sentence in re.split(r"[.!?\n]", text.lower()):
            found = re.findall(r"[^\W\d_]+", sentence)
            if found:
                plain.append(1 / (1 + np.exp(-(bias + sum(float(w[k]) for x in set(found) for k in set(toxicity.features(x)))))))
        plain = plain or [1 / (1 + np.exp(-bias))]
        got = toxicity.sentence_scores(text.lower(), weights, bias)
        assert np.allclose(got, plain, rtol=1e-6)
        own = 1 / (1 + np.exp(-trained[owner == i]))
        # an open sentence after the last end has no words and its prior score in training
        assert np.allclose(own[: len(plain)], plain, rtol=1e-5)


def test_longest_match_over_all_places_of_a_window(spark):
    head = [f"w{i}" for i in range(10)]
    items = [("A", " ".join([*head, "x"])), ("B", " ".join([*head, "y", "z"])), ("C", " ".join(["q", *head, "y", "k", "l"]))]
    docs = documents(spark, [(1, " ".join([*head, "y", "z"])), (2, " ".join(["n", *head, "y", "k"])), (3, " ".join(head))])
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {x.doc_id: (x.longest, x.longest_at, x.longest_item, x.longest_item_at) for x in decontam.contamination(docs, bench).collect()}
    assert got == {1: (12, 0, "B", 0), 2: (12, 1, "C", 1), 3: (10, 0, "A", 0)}


@pytest.mark.parametrize("seed", range(3))
def test_longest_match_equals_brute_force(spark, seed):
    r = random.Random(seed)
    text = lambda n: [r.choice("ab") for _ in range(n)]
    items = [(f"i{k}", text(r.choice([2, 4, 6, 12, 30]))) for k in range(12)]
    docs = [(k, text(r.randint(0, 40))) for k in range(60)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id string, text string")
    got = decontam.contamination(documents(spark, [(i, " ".join(t)) for i, t in docs]), bench, window=4).collect()
    for x in got:
        t, best = dict(docs)[x.doc_id], 0
        for _, item in items:
            for a in range(len(t)):
                for b in range(len(item)):
                    n = 0
                    while a + n < len(t) and b + n < len(item) and t[a + n] == item[b + n]:
                        n += 1
                    best = max(best, n if n >= min(4, len(item)) else 0)
        assert x.longest == best
        if best:
            item = dict(items)[x.longest_item]
            assert item[x.longest_item_at :][:best] == t[x.longest_at :][:best]


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, odd_rows()), none)
    assert got.count() == len(odd_rows()) and got.filter("doc_id < 3 and predicted = 1").isEmpty()
    assert toxicity.toxicity(documents(spark, []), none).count() == 0
