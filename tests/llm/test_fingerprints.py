"""Bottom-k sketches against plain Python, with the xxhash package for the hashes."""

import hashlib
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from reachmap.llm import fingerprints as fp

from .helpers import documents, odd_rows, words


def long_hash(values):
    """Spark's hash of longs: each value's, seeded with the one before."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_set(text, size=fp.SHINGLE):
    w = (text or "").lower()
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [signed(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in w.split(" ") if x]
    return {long_hash(w[i : i + size]) >> (64 - fp.BITS) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_sketch(text, k=fp.K):
    return sorted(plain_set(text))[:k]


def plain_resemblance(a, b, k=fp.K):
    u = sorted(set(a) | set(b))[:k]
    return sum(h in a and h in b for h in u) / len(u) if u else 1.0


def written(s):
    return "".join(f"{h:012x}" for h in s)


def brute(rows):
    """(doc_id, n_chars, sha, fingerprint, edited, near_edited, near_next), nulls as empty."""
    texts = [(i, t or "") for i, t in rows]
    order = sorted((r for r in texts if r[0] is not None), key=lambda r: (-r[0], signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42))))
    following = [(r, order[(j + 1) % len(order)][1]) for j, r in enumerate(order)]
    following += [(r, "") for r in texts if r[0] is None]
    out = []
    for (i, t), after in following:
        m = len(t) // 3
        e = t[: len(t) - m] + after[:m]
        a, b, c = plain_sketch(t), plain_sketch(e), plain_sketch(after)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), written(a), written(b), plain_resemblance(a, b), plain_resemblance(a, c)))
    return sorted(out, key=repr)


def got(spark, rows, tmp_path, extra=False):
    documents(spark, rows, extra).write.parquet(f"{tmp_path}/documents.parquet")
    df = fp.op11_fingerprints(spark, str(tmp_path)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(7 * i, " ".join(words(1 + i * 3 % 400, i // 2))) for i in range(300)]
    assert got(spark, rows, tmp_path, extra=True) == brute(rows)


def test_odd_rows_and_repeated_ids(spark, tmp_path):
    rows = odd_rows() + [(9, "😀 x é" * 50), (9, "other text here"), (-5, "minus"), (None, "😀")]
    assert got(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(3, "alone in the table as it is")], [(None, "no id")]])
def test_tables_of_one_row_or_none(spark, tmp_path, rows):
    assert got(spark, rows, tmp_path) == brute(rows)


def test_sketches_of_parts_merge_to_that_of_the_whole(spark):
    rows = [(i, " ".join(words(50, i)), "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(120)]
    rows.append((500, None, "en", "empty", 0))
    got = {r["source"]: r for r in fp.group_fingerprints(documents(spark, rows)).collect()}
    whole = {}
    for _, t, _, s, _ in rows:
        whole.setdefault(s, set()).update(plain_set(t))
    assert set(got) == set(whole)
    for s, hashes in whole.items():
        assert got[s]["fingerprint"] == written(sorted(hashes)[: fp.K])
        assert got[s]["n_distinct"] == pytest.approx(len(hashes), rel=0.3)


def test_estimates_are_near_the_exact_values(spark):
    base = words(3000, 1)
    rows = [(0, " ".join(base)), (1, " ".join(base[:1500] + words(1500, 2))), (2, " ".join(base[:1000]))]
    a, b, c = (fp.sketch(F.lit(t)) for _, t in rows)
    row = spark.range(1).select(
        fp.resemblance(a, b).alias("ab"), fp.containment(c, a).alias("ca"), fp.containment(a, c).alias("ac"),
        fp.distinct_count(a).alias("n"), (fp.read(fp.written(a)) == a).alias("read"),
    ).first()
    A, B = plain_set(rows[0][1]), plain_set(rows[1][1])
    assert row["ab"] == pytest.approx(len(A & B) / len(A | B), abs=0.12)
    assert row["n"] == pytest.approx(len(A), rel=0.3)
    assert row["ca"] > 0.7 and row["ac"] == pytest.approx(1 / 3, abs=0.15) and row["read"]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = fp.op11_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
