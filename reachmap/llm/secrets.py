"""Secret scans (operator 6): a linear-chain conditional random field over tokens.

Three fixed patterns give the base spans. The field tags every token of a line
as begin, inside or outside of a secret, from the token's shape, neighbouring
words and shapes, and features of the whole file; Viterbi decoding gives the
best tags. Its spans are added where no base span lies.

Every token may begin a secret; whether its shape is a telling one is a feature.
All lines are decoded, many at once with numpy: a token whose tag is surely outside,
whatever the tags around it are, splits a line, and only what is left between such
tokens goes through Viterbi. The tags are those of decoding the whole line.

Trained on a bounded sample: TRAIN_DOCS documents in which a base pattern's
keyword occurs and as many others, those with the smallest hash of their id.
Their base spans are the labels; keywords and punctuation around them are
features, so spans in like surroundings are found which the patterns miss. Pieces
of lines with a base span or a token of telling shape are all learned from; of the
others about PLAIN_PIECES, each with the weight of those it stands for.

Defined results: a null text is empty and has no spans. Repeated rows give rows
alike. Without a base span in the sample the field adds nothing.
"""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, table

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "field")
LEAST = {"assign": 8, "access": 16}

TRAIN_DOCS = 1500
MOST_TOKENS = 96  # training sequences are pieces of lines of this length
PLAIN_PIECES = 1000
MOST_TYPES = 300_000  # different tokens remembered by a task
CHUNK_CHARS = 2_000_000  # of texts that are decoded together
CHUNK_TOKENS = 1 << 16
HASH_BITS = 16
EPOCHS = 40
RATE = 0.5
PENALTY = 1e-3

TOKEN = re.compile(r"\w+|[^\w\s]")
TOKEN_OR_END = re.compile(r"\w+|[^\w\s]|\n")
DIGITS, LOWER, UPPER = (frozenset(x) for x in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
TAGS = ("O", "B", "I")
NEVER = -1e9


def base_spans(text: str):
    """[(kind, start, end)] of the three patterns, leftmost non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs are maximal, so shorter ones need not be matched and dropped.
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered(spans))


def telling(token: str) -> bool:
    """Whether the shape alone suggests a secret."""
    n = len(token)
    return (n >= 8 and not DIGITS.isdisjoint(token)) or (n >= 12 and bool(re.search("[a-z][A-Z]", token)))


def shape(token: str) -> str:
    """Length class and character classes."""
    kinds = (
        ("d" if not DIGITS.isdisjoint(token) else "")
        + ("l" if not LOWER.isdisjoint(token) else "")
        + ("u" if not UPPER.isdisjoint(token) else "")
        + ("" if token.isascii() else "x")
    )
    if not kinds:
        return "p" + token[:1]
    hexa = "h" if len(token) >= 8 and re.fullmatch("[0-9a-f]+", token) else ""
    return f"{kinds}{hexa}{min(7, len(token).bit_length())}"


def spread(token: str) -> int:
    """Bits per character of a token's letter counts, as a class."""
    n = len(token)
    counts = Counter(token).values()
    if len(counts) == n:
        return int(2 * math.log2(n))
    return int(2 * -sum(k / n * math.log2(k / n) for k in counts))


def file_features(text: str):
    """Classes of the file as a whole."""
    n = max(1, len(text))
    return (
        f"len{n.bit_length() // 2}",
        f"eq{min(3, text.count('='))}",
        f"brace{min(3, text.count('{') + text.count(';'))}",
        f"line{min(3, int(4 * text.count(chr(10)) * 80 / n))}",
    )


def _crc(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "replace"))


def _number(kind: int, x, y=None):
    """Feature numbers of one kind for arrays of values."""
    h = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64((kind + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    if y is not None:
        h ^= y * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int32)


class Types(dict):
    """A number for each different token, and what its features are made of. 0 ends a line."""

    def __init__(self):
        self.shapes, self.new = {"-": 0}, [(_crc("-"), 0, 0, 0, 0)]
        self["\n"] = 0
        self.parts = np.empty((0, 5), np.uint64)  # word, own word, shape, spread, telling
        self.shape_crc = np.empty(0, np.uint64)

    def __missing__(self, token):
        low = token[:17].lower()
        word = _crc(low[:16])
        of_shape = self.shapes.setdefault(shape(token), len(self.shapes))
        self.new.append((word, word if len(token) <= 16 else 1, of_shape, spread(token), telling(token)))
        self[token] = n = len(self)
        return n

    def update_parts(self):
        if self.new:
            self.parts = np.concatenate([self.parts, np.array(self.new, np.uint64)])
            self.new = []
            self.shape_crc = np.array([_crc(x) for x in self.shapes], np.uint64)

    def unary(self, lo=0):
        """Feature numbers that a token from `lo` on gives to itself and to its neighbours: {offset: [numbers]}."""
        word, own, of_shape, bits, tells = self.parts[lo:].T
        form = self.shape_crc[of_shape.astype(np.int64)]
        return {
            0: [_number(0, form), _number(1, bits), _number(2, own), _number(3, tells)],
            -3: [_number(4, word)],
            -2: [_number(5, word)],
            -1: [_number(6, word), _number(8, form)],
            1: [_number(7, word), _number(9, form)],
        }


class Tokens:
    """The tokens of texts: type, line and text of each."""

    def __init__(self, texts, types):
        self.types, every, sizes = types, [], []
        for text in texts:
            own = TOKEN_OR_END.findall(text)
            every += own
            every.append("\n")
            sizes.append(len(own) + 1)
        raw = np.fromiter(map(types.__getitem__, every), np.int64, len(every))
        types.update_parts()
        keep = raw != 0
        self.ids = raw[keep]
        self.line = np.cumsum(~keep)[keep]
        self.text = np.repeat(np.arange(len(sizes)), sizes)[keep]
        self.first = np.searchsorted(self.text, np.arange(len(sizes) + 1))
        known = {}
        of = [known.setdefault(file_features(t), len(known)) for t in texts]
        self.file = np.array(of, np.int64)
        self.files = np.array([[_crc(x) for x in f] for f in known], np.uint64).reshape(-1, 4)

    def beside(self, k):
        """The type of the token k places on in the same line, or 0."""
        out, n = np.zeros_like(self.ids), len(self.ids)
        if abs(k) < n:
            to, of = (slice(-k, None), slice(None, k)) if k < 0 else (slice(None, -k), slice(k, None))
            out[to] = np.where(self.line[to] == self.line[of], self.ids[of], 0)
        return out

    def pairs(self, at, one, two):
        """Feature numbers of pairs for the tokens of a slice, from the types one and two places before."""
        word, form = self.types.parts[:, 0], self.types.shape_crc[self.types.parts[:, 2].astype(np.int64)]
        return _number(10, word[one[at]], form[self.ids[at]]), _number(11, word[two[at]], word[one[at]])

    def features(self):
        """Feature numbers, one row a token."""
        numbers = []
        for k, of in self.types.unary().items():
            ids = self.beside(k) if k else self.ids
            numbers += [x[ids] for x in of]
        every = slice(None)
        numbers += self.pairs(every, self.beside(-1), self.beside(-2))
        form = self.types.shape_crc[self.types.parts[self.ids, 2].astype(np.int64)]
        numbers += [_number(12 + j, self.files[self.file[self.text], j], form) for j in range(4)]
        return np.stack(numbers, 1)


class Field:
    """A model that remembers the scores of the tokens it has seen."""

    def __init__(self, w, t):
        self.w, self.t = np.ascontiguousarray(w, np.float32), t
        self.forget()

    def forget(self):
        self.types, self.known = Types(), {k: np.empty((0, 3), np.float32) for k in (0, -3, -2, -1, 1)}

    def scores(self, tokens):
        """Emission scores of tokens."""
        w, types = self.w, self.types
        done = len(self.known[0])
        if done < len(types.parts):
            for k, of in types.unary(done).items():
                self.known[k] = np.concatenate([self.known[k], sum(w[x] for x in of)])
        crc, files = types.shape_crc, tokens.files
        form = np.zeros((len(files), len(crc), 3), np.float32)
        for j in range(4):
            form += w[_number(12 + j, np.repeat(files[:, j], len(crc)), np.tile(crc, len(files)))].reshape(form.shape)
        form = form.reshape(-1, 3)
        of_shape = types.parts[:, 2].astype(np.int64)
        e = self.known[0][tokens.ids]
        near = {k: tokens.beside(k) for k in (-3, -2, -1, 1)}
        for lo in range(0, len(e), CHUNK_TOKENS):
            at = slice(lo, lo + CHUNK_TOKENS)
            for k, ids in near.items():
                e[at] += self.known[k][ids[at]]
            for x in tokens.pairs(at, near[-1], near[-2]):
                e[at] += w[x]
            e[at] += form[tokens.file[tokens.text[at]] * len(crc) + of_shape[tokens.ids[at]]]
        return e

    def spans(self, texts):
        """For each text its spans: tokens begin to last inside."""
        out, lo = [], 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= CHUNK_CHARS:
                size, hi = size + len(texts[hi]), hi + 1
            if len(self.types) > MOST_TYPES:
                self.forget()
            out += self._spans(texts[lo:hi])
            lo = hi
        return out

    def _spans(self, texts):
        tokens = Tokens(texts, self.types)
        out = [[] for _ in texts]
        found = decoded(self.scores(tokens), tokens.line, self.t)
        places = {}
        for a, b in found:
            k = int(tokens.text[a])
            if k not in places:
                places = {k: [x.span() for x in TOKEN.finditer(texts[k])]}
            first = tokens.first[k]
            out[k].append(("field", places[k][a - first][0], places[k][b - first][1]))
        return out


def log_sum(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def allowed_steps():
    """Transition mask: I follows B or I only."""
    a = np.zeros((3, 3))
    a[0, 2] = NEVER
    return a


def fit(sequences):
    """Weights (features x 3) and transitions (3 x 3) by AdaGrad on the conditional likelihood.

    A sequence is (features of each token, tag of each token, weight).
    """
    size = 1 << HASH_BITS
    w, t = np.zeros((size, 3)), np.zeros((3, 3))
    if not any((tags == 1).any() for _, tags, _ in sequences):
        return None
    n, width = len(sequences), max(len(s[1]) for s in sequences)
    k = len(sequences[0][0][0])
    feats = np.zeros((n, width, k), np.int32)
    tags = np.zeros((n, width), np.int64)
    real = np.zeros((n, width), bool)
    weight = np.array([s[2] for s in sequences], float)
    for r, (f, y, _) in enumerate(sequences):
        feats[r, : len(y)], tags[r, : len(y)], real[r, : len(y)] = f, y, True
    count = real * weight[:, None]
    steps = allowed_steps()
    used, code = np.unique(feats[real], return_inverse=True)
    code = code.reshape(-1, k)
    v, sq, sq_t = np.zeros((len(used), 3)), np.full((len(used), 3), 1e-3), np.full((3, 3), 1e-3)
    gold = np.eye(3)[tags] * count[:, :, None]
    pairs = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:] > 0)
    for _ in range(EPOCHS):
        e = np.zeros((n, width, 3))
        e[real] = sum(v[code[:, j]] for j in range(k))
        e[:, 0, 2] = NEVER
        tr = t + steps
        alpha = np.empty_like(e)
        alpha[:, 0] = e[:, 0]
        for i in range(1, width):
            alpha[:, i] = log_sum(alpha[:, i - 1, :, None] + tr[None], 1) + e[:, i]
        beta = np.zeros_like(e)
        for i in range(width - 2, -1, -1):
            nxt = log_sum(tr[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(real[:, i + 1, None], nxt, 0.0)
        last = real.sum(1) - 1
        z = log_sum(alpha[np.arange(n), last], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * count[:, :, None]
        both = np.zeros((3, 3))
        for i in range(1, width):
            x = alpha[:, i - 1, :, None] + tr[None] + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]
            both += (np.exp(np.minimum(x, 0)) * count[:, i, None, None]).sum(0)
        diff = (p - gold)[real]
        grad = np.stack([np.bincount(code.ravel(), np.repeat(diff[:, j], k), minlength=len(used)) for j in range(3)], 1)
        grad = grad / n + PENALTY * v
        sq += grad**2
        v -= RATE * grad / np.sqrt(sq)
        gt = (both - pairs) / n + PENALTY * t
        sq_t += gt**2
        t -= RATE * gt / np.sqrt(sq_t)
    w[used] = v
    return w, t


def viterbi(e, transitions):
    """Best tags of one sequence of emission scores."""
    tr = transitions + allowed_steps()
    score, back = e[0].copy(), np.zeros(e.shape, np.int64)
    score[2] = NEVER
    for i in range(1, len(e)):
        x = score[:, None] + tr
        back[i] = x.argmax(0)
        score = x.max(0) + e[i]
    tags = [int(score.argmax())]
    for i in range(len(e) - 1, 0, -1):
        tags.append(int(back[i][tags[-1]]))
    return tags[::-1]


def decoded(e, line, t):
    """(first token, last token) of the secrets in the best tags of all lines."""
    n = len(e)
    if not n:
        return []
    last = np.r_[line[1:] != line[:-1], True]
    ahead = np.r_[e[1:, 1] - e[1:, 2], 0]
    # By how much a path through another tag gains at least when this tag becomes outside
    # (and an inside after it a begin), whatever the tags around are.
    sure = np.ones(n, bool)
    for tag, before in ((1, (0, 1, 2)), (2, (1, 2))):
        back = min(0, *[t[a, 0] - t[a, tag] for a in before])
        near = min(0, t[0, 0] - t[tag, 0], t[0, 1] - t[tag, 1])
        far = t[0, 1] - t[tag, 2] + min(0, *(t[1] - t[2]))
        sure &= e[:, 0] - e[:, tag] + back + np.where(last, near, np.minimum(near, far + ahead)) > 1e-3
    rest = np.flatnonzero(~sure)
    cuts = np.flatnonzero((np.diff(rest) > 1) | (np.diff(line[rest]) > 0)) + 1
    out = []
    for run in np.split(rest, cuts) if len(rest) else []:
        lo, hi = run[0], run[-1] + 1
        own = e[lo:hi].astype(float)
        if lo and line[lo - 1] == line[lo]:
            own[0] += t[0]
        if hi < n and line[hi] == line[lo]:
            own[-1] += t[:, 0]
        tags, i = viterbi(own, t), 0
        while i < len(tags):
            if tags[i] == 1:
                j = i
                while j + 1 < len(tags) and tags[j + 1] == 2:
                    j += 1
                out.append((int(lo) + i, int(lo) + j))
                i = j
            i += 1
    return out


def field_spans(text: str, model):
    """Spans that the field finds in one text."""
    return Field(*model).spans([text])[0] if model is not None else []


def all_spans(texts, field):
    """For each text (base spans, spans added by the field)."""
    out = []
    for text, more in zip(texts, field.spans(texts) if field else [[]] * len(texts), strict=True):
        base = base_spans(text)
        out.append((base, [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in base)]))
    return out


def training_sequences(texts):
    """Pieces of all lines with their tags, from base spans."""
    tokens = Tokens(texts, Types())
    tags = np.zeros(len(tokens.ids), np.int64)
    for k, text in enumerate(texts):
        secret = sorted((ASSIGN.match(text, a).start(2) if kind == "assign" else a, b) for kind, a, b in base_spans(text))
        if not secret:
            continue
        start, end = np.array([x.span() for x in TOKEN.finditer(text)]).T
        own, joint = tags[tokens.first[k] : tokens.first[k + 1]], []
        for a, b in secret:  # spans that overlap are one
            if joint and a < joint[-1][1]:
                joint[-1][1] = max(b, joint[-1][1])
            else:
                joint.append([a, b])
        for a, b in joint:
            lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(start, b, "left")
            while lo < hi and own[lo]:
                lo += 1
            if lo < hi:
                own[lo:hi] = 2
                own[lo] = 1
    feats = tokens.features()
    likely = (tags > 0) | (tokens.types.parts[tokens.ids, 4] > 0)
    borders = np.flatnonzero(np.r_[True, tokens.line[1:] != tokens.line[:-1], True]) if len(tags) else []
    out, plain = [], []
    for at, end in zip(borders[:-1], borders[1:], strict=True):
        while at < end:
            hi = min(end, at + MOST_TOKENS)
            while at < hi < end and tags[hi] == 2:  # not within a secret, if it fits
                hi -= 1
            hi = hi if hi > at else min(end, at + MOST_TOKENS)
            (out if likely[at:hi].any() else plain).append((at, hi))
            at = hi
            while at < end and tags[at] == 2:
                at += 1
    some = plain[:: max(1, len(plain) // PLAIN_PIECES)]
    weighted = [(x, 1.0) for x in out] + [(x, len(plain) / len(some)) for x in some]
    return [(feats[a:b], tags[a:b], weight) for (a, b), weight in weighted]


def training_rows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Texts of the sample: at most 2 * train_docs."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    low = F.lower("text")
    likely = F.lit(False)
    for w in WORDS:
        likely = likely | F.contains(low, F.lit(w))
    likely = likely | F.contains(F.col("text"), F.lit("AKIA"))
    ids = rows.select("doc_id", likely.alias("likely"), F.xxhash64("doc_id").alias("h"))
    pick = ids.filter("likely").orderBy("h", "doc_id").limit(train_docs)
    pick = pick.union(ids.filter("not likely").orderBy("h", "doc_id").limit(train_docs))
    found = rows.join(F.broadcast(pick.select("doc_id").distinct()), "doc_id")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(2 * train_docs)


def _train(batches):
    texts = sorted(x for b in batches for x in b.column("text").to_pylist())
    model = fit(training_sequences(texts)) if texts else None
    if model is not None:
        yield pa.RecordBatch.from_pydict(
            {
                "w": pa.array([model[0].astype(np.float32).tobytes()], pa.binary()),
                "t": pa.array([model[1].tobytes()], pa.binary()),
            }
        )


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS):
    """(weights, transitions) or None; the bounded sample is fitted in one task."""
    row = training_rows(docs, train_docs).coalesce(1).mapInArrow(_train, "w binary, t binary").first()
    if row is None:
        return None
    return np.frombuffer(row["w"], np.float32).reshape(-1, 3), np.frombuffer(row["t"], np.float64).reshape(3, 3)


def _scan_with(model):
    def run(batches):
        field = Field(*model.value) if model.value is not None else None
        for batch in batches:
            rows = []
            for base, more in all_spans(batch.column("text").to_pylist(), field):
                n = {k: sum(s[0] == k for s in base) for k in KINDS}
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, joined(base + more), len(more)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64()]
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_field"]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id")}
                | {c: pa.array(v, k) for c, v, k in zip(names, cols, kinds, strict=True)}
            )

    return run


def scan_secrets(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per document: counts and digest of the base spans, and all spans."""
    model = in_small_batches(docs).sparkSession.sparkContext.broadcast(train(docs, train_docs))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        _scan_with(model),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_field long",
    )


def op6_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
