"""PII (operator 7): candidate gradient boosting, with DataFrame functions only.

Four fixed patterns give the base spans, which always stay. Generators of higher
recall propose further, overlapping spans: loose and spelled-out addresses, runs
of digits, groups of digits and obfuscated octets. Boosted trees score a proposal
from its format and from the text between it and its neighbours; a threshold for
each generator is calibrated on rows not trained on. Of the proposals that touch
no base span those above it are added, of a run of overlapping ones the best.

No table says what the base patterns miss, so the trees learn from base spans
rewritten into forms that no base pattern has ("a.b(at)c.de", "0044 ...", cards in
dotted groups) where they stand. Against them stand base spans spoilt in the
same forms (a wrong check digit, an octet above 255, an address without a domain,
dates and serial numbers) and the proposals that touch no base span, which are
mostly not personal. Both classes weigh the same within a generator.

Trained and calibrated on every base span and every free proposal of the table. Rows
alike in features, label and part are one, weighted by their number, so the trees
see each distinct row once. (Of continuous features `pyspark.ml` itself picks the
candidates of a split from quantiles of some of these rows.)

Positions are sums over blocks of matches and overlaps are found by sorting, so the
work grows evenly with a text's length and its matches. Every proposal of a text is
a row of its own; a text with very many is one sorted run, which spills.

Defined results: a null text is empty. Repeated rows give rows alike. Of overlapping
proposals alike in score the first, then the longer one is taken. Without base spans
to learn from, none are added.
"""

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from .common import table, text_of

# The patterns of the base spans. Where a match can only begin at the first
# character of a run, or where the last match ended, it is said so: the matches
# are the same, but long runs are not tried again from each of their places.
# Nothing that follows a repetition could take back part of it, so they are
# possessive: the matcher then needs no stack for very long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposals. Those of one generator never overlap.
GENERATORS = {
    "at": r"(?:\G|(?<![^\x20\x09-\x0D@]))[^\x20\x09-\x0D@]+(?:@|[(\[]at[)\]])[^\x20\x09-\x0D@]+",
    "digits": r"[+(]?[0-9][0-9().:/\x20-]{5,}[0-9]",
    "spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20[(\[]?(?:at|AT)[)\]]?\x20[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20[(\[]?(?:dot|DOT)[)\]]?\x20)[A-Za-z0-9-]++)++",
    "groups": r"(?<![0-9])[0-9]{3,6}(?:[\x20._/,:-]{1,3}[0-9]{3,6}){2,4}+(?![0-9])",
    "octets": r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|[,_-]|\x20dot\x20)[0-9]{1,3}){3}(?![0-9])",
}
# A text without one of these cannot match.
NEEDS = {
    "email": ("@",),
    "phone": ("+",),
    "at": ("@", "(at)", "(at]", "[at)", "[at]"),
    "spelled": (" at ", " AT ", "at) ", "at] ", "AT) ", "AT] "),
}
KEYWORDS = {
    "mail_near": ("mail", "contact", "write", "address"),
    "phone_near": ("tel", "phone", "call", "mobile", "fax"),
    "card_near": ("card", "visa", "account", "iban", "pay"),
    "ip_near": ("ip", "host", "server"),
}
BEFORE, AFTER = 24, 8

TREES, DEPTH = 16, 4
PRECISION = 0.95
SEED = 7
BLOCK = 256


def let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def running_sums(steps: Column) -> Column:
    """The sums of a number array up to each place, by blocks: arrays grow by appending within a block only."""
    block = lambda i: F.slice(steps, i * BLOCK + 1, F.lit(BLOCK))
    grown = lambda values, first: F.aggregate(
        values,
        F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")),
    )["out"]
    numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    totals = F.transform(numbers, lambda i: F.aggregate(block(i), F.lit(0), lambda acc, x: acc + x))
    begun = let(totals, lambda t: F.zip_with(grown(t, F.lit(0)), t, lambda end, x: end - x))
    return F.flatten(F.zip_with(begun, numbers, lambda first, i: grown(block(i), first)))


SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"


def located(text: Column, found: Column, pattern: str) -> Column:
    """array<SPAN> of the matches `found` of a pattern, in code points.

    `before` and `after` reach to the neighbouring matches of the pattern at most.
    """
    pieces = F.split(text, F.lit(pattern), F.lit(-1))
    both = let(
        pieces,
        lambda p: F.arrays_zip(
            F.slice(p, 1, F.size(found)).alias("gap"), found.alias("value"), F.slice(p, 2, F.size(found)).alias("next")
        ),
    )
    ends = lambda b: let(F.transform(b, lambda x: F.length(x["gap"]) + F.length(x["value"])), running_sums)
    span = lambda x, end: F.struct(
        (end - F.length(x["value"])).alias("start"),
        end.alias("end"),
        x["value"].alias("value"),
        F.right(x["gap"], F.lit(BEFORE)).alias("before"),
        F.left(x["next"], F.lit(AFTER)).alias("after"),
    )
    walked = let(both, lambda b: F.zip_with(b, ends(b), span))
    return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(f"array<{SPAN}>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    digit = lambda i: F.substring(F.reverse(number), i, F.lit(1)).cast("int")
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(number)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)),
    )
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        fits = lambda p: (F.length(part(p)) <= 3) & (part(p).cast("int") <= 255)
        return F.forall(F.split(value, r"\."), fits)
    if kind == "card":
        return F.length(digits(value)).between(16, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def _has(value: Column, pattern: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))


def features(generator: Column, v: Column, before: Column, after: Column) -> dict[str, Column]:
    """What the trees see of a proposal: its format and what is around it."""
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
    near = F.lower(before)
    n_digits = F.length(digits(v))
    some = lambda words: reduce(lambda a, b: a | b, [F.contains(near, F.lit(k)) for k in words])
    out = {
        "generator": generator,
        "length": F.length(v),
        "digits": n_digits,
        "letters": _has(v, "[A-Za-z]"),
        "dots": _has(v, r"\."),
        "dashes": _has(v, "-"),
        "spaces": _has(v, r"\x20"),
        "brackets": _has(v, r"[()\[\]]"),
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "octets": (F.size(groups) == 4) & F.forall(groups, lambda g: (F.length(g) <= 3) & (g.cast("int") <= 255)),
        "luhn": F.when(n_digits.between(13, 19), luhn(digits(v))).otherwise(False),
        "date": F.rlike(v, F.lit(r"^(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|[0-9]{1,2}:[0-9]{2})")),
        "plus": F.startswith(v, F.lit("+")),
        "zero": F.rlike(v, F.lit(r"^\(?0")),
        "at": F.contains(v, F.lit("@")),
        "domain": F.rlike(v, F.lit(r"(?i)(?:\.|dot)[)\]]?\x20?[a-z]{2,}$")),
        "before_word": F.rlike(before, F.lit(r"[\p{L}]$")),
        "after_word": F.rlike(after, F.lit(r"^[\p{L}]")),
        "before_digit": F.rlike(before, F.lit(r"[0-9]\S?$")),
        "after_digit": F.rlike(after, F.lit(r"^\S?[0-9]")),
        "ends_dot": F.rlike(v, F.lit(r"[.,;:]$")),
        **{name: some(words) for name, words in KEYWORDS.items()},
    }
    return {name: c.cast("double") for name, c in out.items()}


FEATURES = (
    "generator", "length", "digits", "letters", "dots", "dashes", "spaces", "brackets", "groups", "longest_group", "octets",
    "luhn", "date", "plus", "zero", "at", "domain", "before_word", "after_word", "before_digit", "after_digit", "ends_dot",
    *KEYWORDS,
)


def rewritten(kind: Column, v: Column) -> Column:
    """array<struct<value, label>>: a base span in forms the base patterns lack (1), and spoilt ones (0)."""
    local, domain = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    dotted = lambda c, dot: F.replace(c, F.lit("."), F.lit(dot))
    number = digits(v)
    fours = lambda n, mark: F.regexp_replace(n, "([0-9]{4})(?=[0-9]{3})", f"$1{mark}")
    wrong = F.concat(F.left(number, F.length(number) - 1), F.translate(F.right(number, F.lit(1)), "0123456789", "1234567890"))
    home = F.regexp_replace(v, r"^\+[0-9]{1,2}[^0-9(]*", "")
    two = lambda i: F.substring(number, i, 2)
    forms = {
        "email": (
            [F.concat(local, F.lit("(at)"), domain), F.concat(local, F.lit("[at]"), dotted(domain, "[dot]")),
             F.concat(local, F.lit(" at "), dotted(domain, " dot ")), F.concat(local, F.lit(" (at) "), domain)],
            [F.concat(local, F.lit("(at)"), F.substring_index(domain, ".", 1)), F.concat(F.lit("@"), local, F.lit("@"), local),
             F.concat(F.lit("look at "), F.right(number, F.lit(1)), F.lit("1.5"))],
        ),
        "phone": (
            [F.regexp_replace(v, r"^\+", "00"), F.concat(F.lit("0"), home), home],
            [F.concat(F.lit("20"), two(1), F.lit("-0"), F.right(number, F.lit(1)), F.lit("-1"), F.substring(number, 2, 1)),
             F.concat(number, number), F.concat(two(1), F.lit(":"), two(3), F.lit(":"), two(5)), F.concat(two(1), F.lit("."), two(3), F.lit(".20"), two(5))],
        ),
        "card": (
            [fours(number, "."), fours(number, "/"), fours(number, " - "), fours(number, "_")],
            [fours(wrong, "."), fours(wrong, "/"), fours(wrong, " - "), fours(wrong, "_"), wrong],
        ),
        "ip": (
            [dotted(v, "[.]"), dotted(v, "(.)"), dotted(v, " dot "), dotted(v, "-")],
            [dotted(F.regexp_replace(v, "^[0-9]+", "9" * 3), mark) for mark in ("[.]", "(.)", " dot ", "-")],
        ),
    }
    row = lambda c, label: F.struct(c.alias("value"), F.lit(label).alias("label"))
    out = F.array().cast("array<struct<value:string,label:double>>")
    for name, (good, bad) in forms.items():
        out = F.when(kind == name, F.array(*[row(c, 1.0) for c in good], *[row(c, 0.0) for c in bad])).otherwise(out)
    return out


def spans_of(docs: DataFrame) -> DataFrame:
    """row, doc_id, base: array<struct<kind, SPAN...>>, proposals: array<struct<generator, SPAN...>>."""
    names = {**BASE, **GENERATORS}
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def found(name):
        every = F.regexp_extract_all("text", F.lit(names[name]), F.lit(0))
        if name not in NEEDS:
            return every
        some = reduce(lambda a, b: a | b, [F.contains("text", F.lit(x)) for x in NEEDS[name]])
        return F.when(some, every).otherwise(F.array().cast("array<string>"))

    def tagged(name, tag, spans):
        fields = ("start", "end", "value", "before", "after")
        return F.transform(spans, lambda x: F.struct(tag, *[x[f].alias(f) for f in fields]))

    rows = rows.select("doc_id", "text", *[found(n).alias(f"found_{n}") for n in names])
    rows = rows.select("doc_id", *[located(F.col("text"), F.col(f"found_{n}"), p).alias(n) for n, p in names.items()])
    kept = {n: F.filter(n, lambda x: valid(n, x["value"])) for n in BASE}
    base = [tagged(n, F.lit(n).alias("kind"), kept[n]) for n in BASE]
    proposals = [tagged(n, F.lit(i).alias("generator"), F.col(n)) for i, n in enumerate(GENERATORS)]
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*base).alias("base"), F.concat(*proposals).alias("proposals")
    )


def free_proposals(spans: DataFrame) -> DataFrame:
    """Proposals that touch no base span, a row each."""
    some = spans.filter(F.size("proposals") > 0)
    base = some.select("row", "doc_id", F.explode("base").alias("s")).select(
        "row", "doc_id", F.lit(-1).alias("generator"), *[F.col(f"s.{f}").alias(f) for f in ("start", "end")],
        *[F.lit(None).cast("string").alias(f) for f in ("value", "before", "after")],
    )
    every = base.unionByName(some.select("row", "doc_id", F.explode("proposals").alias("s")).select("row", "doc_id", "s.*"))
    is_base = F.col("generator") < 0
    # Of the base spans that begin no later the furthest end, of those that begin no earlier the first start.
    up = W.partitionBy("row").orderBy("start", "generator").rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy("row").orderBy(F.desc("start"), "generator").rowsBetween(W.unboundedPreceding, 0)
    every = every.withColumn("base_end", F.max(F.when(is_base, F.col("end"))).over(up))
    every = every.withColumn("base_start", F.min(F.when(is_base, F.col("start"))).over(down))
    touched = (F.coalesce("base_end", F.lit(0)) > F.col("start")) | (F.coalesce(F.col("base_start") < F.col("end"), F.lit(False)))
    return every.filter(~is_base & ~touched).drop("base_end", "base_start")


def _tree(node) -> Column:
    """A fitted tree as an expression over feature columns."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    test = F.col(FEATURES[split.featureIndex()]) <= float(split.threshold())
    return F.when(test, _tree(node.leftChild())).otherwise(_tree(node.rightChild()))


def _part(*keys) -> Column:
    """One of four parts, by hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(4)).alias("part")


def training_rows(spans: DataFrame, free: DataFrame) -> DataFrame:
    """Distinct features with label, part (0: held out to set thresholds) and weight: their number, balanced by class."""
    base = spans.select("doc_id", F.explode("base").alias("s")).select("s", _part("doc_id", "s.start", "s.kind"))
    forms = base.select("part", "s.before", "s.after", F.explode(rewritten(F.col("s.kind"), F.col("s.value"))).alias("f"))
    fits = [F.when(F.rlike("f.value", F.lit(f"^(?:{p})$")), F.lit(i)) for i, p in enumerate(GENERATORS.values())]
    forms = forms.select(
        "part", "before", "after", "f.*", F.explode(F.filter(F.array(*fits), lambda g: g.isNotNull())).alias("generator")
    )
    plain = free.select(
        _part("doc_id", "start", "generator"), "before", "after", "value", F.lit(0.0).alias("label"), "generator"
    )
    every = forms.unionByName(plain)
    feats = features(*[F.col(c) for c in ("generator", "value", "before", "after")])
    every = every.select("part", "label", *[feats[f].alias(f) for f in FEATURES])
    alike = every.groupBy("part", "label", *FEATURES).agg(F.count("*").alias("alike"))
    rows = cut(alike, "pii-training")
    n = rows.groupBy("generator").agg(F.sum(F.col("label") * F.col("alike")).alias("good"), F.sum("alike").alias("n"))
    ratio = F.when(F.col("label") == 1, (F.col("n") - F.col("good")) / F.col("good")).otherwise(1.0)
    # Of a generator with one class only, which decides nothing, rows keep their weight.
    weight = F.when((F.col("good") > 0) & (F.col("good") < F.col("n")), ratio).otherwise(1.0) * F.col("alike")
    return rows.join(F.broadcast(n), "generator").withColumn("weight", weight).drop("good", "n", "alike")


def train(spans: DataFrame, free: DataFrame):
    """(score expression over features, threshold of each generator) or None."""
    rows = training_rows(spans, free)
    kinds = {r["label"] for r in rows.filter("part != 0").select("label").distinct().collect()}
    if kinds != {0.0, 1.0}:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(rows.filter("part != 0"))
    model = GBTClassifier(
        featuresCol="v", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=SEED
    ).fit(vectors.select("v", "label", "weight"))
    margin = reduce(
        lambda a, b: a + b, [_tree(t._java_obj.rootNode()) * F.lit(float(w)) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    )
    score = 1 / (1 + F.exp(-2 * margin))

    # The lowest score, in steps of 0.02, from which on proposals are right often enough.
    bins = (
        rows.filter("part = 0")
        .select("generator", "weight", "label", F.floor(score * 50).alias("bin"))
        .groupBy("generator", "bin")
        .agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("good"))
        .collect()
    )
    limits = {}
    for g in range(len(GENERATORS)):
        n = good = 0
        limits[g] = 1.01
        for r in sorted((r for r in bins if r["generator"] == g), key=lambda r: -r["bin"]):
            n, good = n + r["n"], good + r["good"]
            # never below even odds, where a held-out part may have no counterexample
            if good >= PRECISION * n and r["bin"] >= 25:
                limits[g] = r["bin"] / 50
    return score, limits


def selected(free: DataFrame, model) -> DataFrame:
    """row and added: the spans that the model selects of a text."""
    score, limits = model
    feats = features(*[F.col(c) for c in ("generator", "value", "before", "after")])
    limit = reduce(lambda rest, g: F.when(F.col("generator") == g, limits[g]).otherwise(rest), limits, F.lit(1.01))
    scored = free.select("row", "start", "end", *[feats[f].alias(f) for f in FEATURES])
    picked = scored.select("row", "start", "end", score.alias("score"), limit.alias("limit")).filter("score >= limit")
    order = W.partitionBy("row").orderBy("start", "end")
    apart = F.col("start") >= F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = picked.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(order.rowsBetween(W.unboundedPreceding, 0)))
    best = runs.groupBy("row", "run").agg(
        F.max(F.struct("score", (-F.col("start")).alias("first"), "end")).alias("best")
    )
    span = F.struct(F.lit("model").alias("kind"), (-F.col("best.first")).alias("start"), F.col("best.end").alias("end"))
    return best.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("added"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans of every document."""
    spans = cut(spans_of(docs), "pii-spans")
    free = cut(free_proposals(spans), "pii-free")
    model = train(spans, free)
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    if model is None:
        return spans.select("doc_id", base.alias("base"), none.alias("added"))
    # Only texts with proposals are shuffled.
    without = spans.filter(F.size("proposals") == 0).select("doc_id", base.alias("base"), none.alias("added"))
    some = spans.filter(F.size("proposals") > 0).select("row", "doc_id", base.alias("base"))
    some = some.join(selected(free, model), "row", "left")
    return without.unionByName(some.select("doc_id", "base", F.coalesce("added", none).alias("added")))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets.

    Spans that overlap are replaced together, by the kind of the first.
    """
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    walked = F.aggregate(
        order,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
    )
    return F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))


def op7_pii(spark, sf_dir):
    spans = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
