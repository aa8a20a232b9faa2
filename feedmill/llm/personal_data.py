"""Personal data by weak supervision.

Four kinds have an exact definition (e-mail and IP addresses, card and phone numbers);
their spans always stand. Looser spans are candidates: numbers and names that fail the
definitions, written-out addresses, keys after words such as ``token``. Labelers vote on
every span: its regular form, a gazetteer, the words before it and the characters around
it. Expectation-maximisation estimates how reliable each labeler is from the votes alone,
over all spans of the corpus, and so gives every pattern of votes a probability. A logistic
classifier of the span's form and context is trained on these probabilities and decides
each candidate.

Votes and features take few values, so the corpus reaches the estimates as one count a
pattern; spans are found in the tasks that read the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from feedmill.llm.pieces import in_slices
from feedmill.llm.tables import in_steps, text_of
from feedmill.session import cut

# The four kinds with an exact definition, in the order of the digest.
KINDS = ("email", "ip", "card", "phone")
# Kinds that only the method finds.
ADDED = ("email_words", "number", "secret")

_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins.
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?<![0-9]{2})(?:[\x20-]?[0-9])+")
_DIGIT = re.compile(r"[0-9]")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates: an address in words, a long number that is no card, a key after its name.
# Repetitions are bounded, or of one class up to its end, so that no text makes a search go back far.
_EMAIL_WORDS = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,63})+", re.IGNORECASE)
_DOT = re.compile("dot", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9](?<![0-9A-Za-z.][0-9])(?:[ ()./-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
_SECRET = re.compile(r"(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|key)\s{0,2}[:=]\s{0,2}[\"']?([A-Za-z0-9_/+=.-]{7,}[A-Za-z0-9_/+=-])", re.IGNORECASE)

# Words that announce personal data, and public suffixes that are common.
CUES = ("mail", "e-mail", "email", "contact", "write", "phone", "tel", "call", "mobile", "fax", "card", "visa", "account", "iban",
        "ssn", "ip", "host", "address", "token", "secret", "password", "key", "login", "user", "telefon", "correo", "courriel", "konto")
SUFFIXES = frozenset("com org net edu gov mil int info biz io de fr es it uk eu us ch at nl be pt br mx jp cn in ru".split())
CARD_FIRST = frozenset("3456")
_CUE = re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, CUES)) + r")(?![a-z])")

# A candidate is a span if its probability is at least this.
ACCEPT = 0.5
LABELERS = 4
# The classifier's features: kind (7), digits (6), length (6), cue (2), marks around (3), mixed letters and digits (2),
# a right check digit (2).
_FEATURES = (7, 6, 6, 2, 3, 2, 2)


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four kinds, by kind and start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append(("email", start, end))
        at = text.find("@", max(end, at + 1))
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def candidate_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that only the method can accept; none overlaps a base span."""
    found = [("email_words", *m.span()) for m in _EMAIL_WORDS.finditer(text)] if _DOT.search(text) else []
    if _DIGIT.search(text):
        found += [("number", *m.span()) for m in _NUMBER.finditer(text)]
    if "=" in text or ":" in text:
        found += [("secret", *m.span(1)) for m in _SECRET.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    out, k = [], 0
    # Of candidates that start together the longest counts: a key may begin as a number does.
    for kind, start, end in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if (k == len(taken) or taken[k][0] >= end) and (not out or out[-1][2] <= start):
            out.append((kind, start, end))
    return out


def _digits_class(n: int) -> int:
    return 0 if n == 0 else 1 if n < 7 else 2 if n < 9 else 3 if n < 13 else 4 if n <= 19 else 5


def _size_class(n: int) -> int:
    return 0 if n < 8 else 1 if n < 13 else 2 if n < 20 else 3 if n < 32 else 4 if n < 64 else 5


def _describe(text: str, kind: str, start: int, end: int) -> tuple[int, int]:
    """Pattern of the votes (base 3: against, none, for) and of the features of a span."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    before = text[max(0, start - 40):start].lower()
    cue = _CUE.search(before) is not None
    around = text[start - 1:start] + text[end:end + 1]
    marks = 2 if any(c in "#$%&*|<>" for c in around) else 1 if around.strip() else 0
    mixed = int(digits > 0 and letters > 0)
    number = "".join(c for c in span if "0" <= c <= "9")

    form = 1 if kind in KINDS else 0 if kind in ("email_words", "secret") else (-1 if digits < 8 else 0)
    if kind in ("email", "email_words"):
        gazetteer = 1 if span.lower().split(".")[-1].split(" ")[-1] in SUFFIXES else -1
    elif kind == "card" or kind == "number" and digits >= 13:
        gazetteer = (1 if luhn(number) else -1) if number[0] in CARD_FIRST else -1
    elif kind == "secret":
        gazetteer = 1 if digits and letters and len(span) >= 16 else -1
    elif kind == "phone":
        gazetteer = 1 if number[0] != "0" else 0
    elif kind == "ip":
        gazetteer = -1 if number[0] == "0" else 1
    else:
        gazetteer = 0
    context = 1 if cue or kind == "secret" else 0 if kind in KINDS else -1
    shape = -1 if marks == 2 and kind not in KINDS else 1 if (mixed if kind in ("secret", "email", "email_words") else span[:1] in "+(" or digits >= 13 or "." in span) else 0
    votes = 0
    for vote in (form, gazetteer, context, shape):
        votes = votes * 3 + vote + 1
    features = 0
    # A key that is longer than most is as much a key.
    size = _size_class(min(len(span), 63) if kind == "secret" else len(span))
    values = ((*KINDS, *ADDED).index(kind), _digits_class(digits), size, int(cue), marks, mixed, int(len(number) >= 13 and luhn(number)))
    for base, value in zip(_FEATURES, values, strict=True):
        features = features * base + value
    return votes, features


_SPANS = ArrayType(
    StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType())
    .add("votes", IntegerType()).add("features", IntegerType()))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.int32()), ("features", pa.int32())]))


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its text replaced by base_spans and candidates, both with votes."""
    place = docs.columns.index(text_col)
    rest = [k for k in range(len(docs.columns)) if k != place]
    names = [*(docs.columns[k] for k in rest), "base", "candidates"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_steps(batches):
            row = 0
            for texts in in_slices(batch.column(place).to_pylist()):
                both: tuple[list, list] = [], []
                for text in texts:
                    base = base_spans(text)
                    for out, spans in zip(both, (base, candidate_spans(text, base)), strict=True):
                        described = [(k, s, e, *_describe(text, k, s, e)) for k, s, e in spans]
                        out.append([dict(zip(("kind", "start", "end", "votes", "features"), x, strict=True)) for x in described])
                part = batch.slice(row, len(texts))
                row += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in rest), *(pa.array(x, _SPAN_TYPE) for x in both)],
                    names=names)

    schema = docs.drop(text_col).schema.add("base", _SPANS).add("candidates", _SPANS)
    return docs.withColumn(text_col, text_of(text_col)).mapInArrow(run, schema)


def estimate_reliabilities(patterns: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Probability of each vote pattern to be personal data, and of every labeler's votes
    (label, labeler, vote) the probability, by expectation-maximisation over counts.

    Labelers start out better than chance; which of the two labels means personal data is
    thereby fixed.
    """
    keys = np.array(sorted(patterns), dtype=np.int64)
    counts = np.array([patterns[k] for k in keys.tolist()], dtype=np.float64)
    votes = np.stack([keys // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS)], axis=1)
    table = np.tile(np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]])[:, None, :], (1, LABELERS, 1))
    prior = np.array([0.5, 0.5])
    for _ in range(rounds):
        like = np.stack([prior[y] * table[y][np.arange(LABELERS), votes].prod(axis=1) for y in (0, 1)], axis=1)
        post = like / like.sum(axis=1, keepdims=True)
        mass = post * counts[:, None]
        # A prior of some votes keeps each labeler better than chance where there are few spans.
        for y in (0, 1):
            for j in range(LABELERS):
                got = np.bincount(votes[:, j], weights=mass[:, y], minlength=3) + (np.array([20, 10, 5]) if y == 0 else np.array([5, 10, 20]))
                table[y, j] = got / got.sum()
        prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
    return dict(zip(keys.tolist(), post[:, 1].tolist(), strict=True)), table


def _one_hot(features: np.ndarray) -> np.ndarray:
    rest, parts = features.copy(), []
    for size in reversed(_FEATURES):
        parts.append(np.eye(size)[rest % size])
        rest = rest // size
    return np.concatenate([*parts, np.ones((len(features), 1))], axis=1)


def train_classifier(features: np.ndarray, truth: np.ndarray, weight: np.ndarray, rounds: int = 400, ridge: float = 0.1) -> np.ndarray:
    """Weights of the logistic classifier of span features, from soft labels."""
    x = _one_hot(features)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (weight * (p - truth)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(spans: DataFrame) -> dict[int, float]:
    """Probability of every feature pattern; ``spans`` has the columns of ``find_spans``."""
    each = spans.select(F.explode(F.concat("base", "candidates")).alias("s")).groupBy("s.votes", "s.features").agg(F.count("*").alias("n"))
    # Votes and features have a few thousand patterns, whatever the corpus.
    rows = each.collect()
    if not rows:
        return {}
    votes: dict[int, int] = {}
    for r in rows:
        votes[r["votes"]] = votes.get(r["votes"], 0) + r["n"]
    likely, _ = estimate_reliabilities(votes)
    features = np.array([r["features"] for r in rows], dtype=np.int64)
    counts = np.array([r["n"] for r in rows], dtype=np.float64)
    known = np.unique(features)
    # One span of every pattern that is no personal data: a pattern must earn its place.
    w = train_classifier(
        np.concatenate([features, known]), np.concatenate([[likely[r["votes"]] for r in rows], np.zeros(len(known))]),
        np.concatenate([counts, np.ones(len(known))]))
    return dict(zip(known.tolist(), (1 / (1 + np.exp(-_one_hot(known) @ w))).tolist(), strict=True))


def detect(docs: DataFrame, *, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` without its text, with base and added: arrays of kind, start, end.

    Base spans are those of the definitions; added ones are the candidates the classifier
    accepts. Offsets count code points, the end is exclusive. A null or empty text has none;
    repeated rows and null ids are kept as they are; columns of ``docs`` named base, added
    or candidates are replaced. The spans are stored once, for learning and for the
    verdict, so the texts are read once.
    """
    spans = cut(find_spans(docs.drop(*({"base", "added", "candidates"} - {text_col})), text_col), "spans")
    chances = learn(spans)
    accepted = [k for k, p in chances.items() if p >= accept]
    keep = F.array(*[F.lit(k) for k in sorted(accepted)]).cast("array<int>")
    plain = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    taken = F.filter("candidates", lambda x: F.array_contains(keep, x["features"]))
    return spans.select(
        *[c for c in spans.columns if c not in ("base", "candidates")],
        F.transform("base", plain).alias("base"), F.transform(taken, plain).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, a count of each base kind, base_sha256, spans, n_added and a count of each
    added kind, of ``detect``'s result."""
    def of_kind(kind: str):
        return lambda x: x["kind"] == kind

    order = F.array(*[F.lit(k) for k in (*KINDS, *ADDED)])
    ranked = lambda spans: F.transform(F.sort_array(F.transform(spans, lambda x: F.struct(
        F.array_position(order, x["kind"]).alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))),
        lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        *[F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(ranked(F.col("base")), ","), 256).alias("base_sha256"),
        F.array_join(ranked(F.concat("base", "added")), ",").alias("spans"), F.size("added").cast("long").alias("n_added"),
        *[F.size(F.filter("added", of_kind(k))).cast("long").alias(f"n_{k}") for k in ADDED])


def mask(docs: DataFrame, *, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in angle brackets, such as
    ``<EMAIL>``; where spans overlap, the stretch they cover becomes the first one's kind.
    Null texts stay null."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(text_col).alias("text"))
    found = detect(packed, accept=accept).select("whole", "base", "added")
    place = docs.columns.index(text_col)
    names = docs.columns

    def replaced(text: str | None, spans: list[dict]) -> str | None:
        if not text or not spans:
            return text
        out, at = [], 0
        for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
            if span["start"] >= at:
                out += [text[at:span["start"]], f"<{span['kind'].upper()}>"]
            at = max(at, span["end"])
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_steps(batches):
            columns = batch.column(0).flatten()
            base, added = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts = columns[place].to_pylist()
            columns[place] = pa.array([replaced(t, b + a) for t, b, a in zip(texts, base, added, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(run, docs.schema)
