"""Personal data by weak supervision (operator 5).

Fixed patterns give the base spans. Looser candidates (assigned secrets, card
numbers run together, identity numbers, names) are judged by labelers that vote
for or against or abstain: shape patterns, a gazetteer and the words around. How
often each pattern of votes occurs in the whole corpus is all that is gathered;
expectation-maximisation turns it into reliabilities and posteriors, on which a
logistic span classifier learns. A second pass adds the spans it accepts.
"""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.common import map_rows, quoted
from landfall.llm.words import PlainWords, slices

# Base kinds, in the order that breaks ties, then those the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id", "name")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# The base patterns. Where the plain pattern could be tried again and again inside one run of
# characters, a possessive repeat or a look-behind says the same in one try.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates beyond the base.
SECRET = re.compile(r"""[=:]\s{0,3}["']?([A-Za-z0-9+/_.-]{16,})""")
# A long token with a digit and both cases, wherever it stands, or one that begins as issued keys do.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.@-])(?=[A-Za-z_-]*[0-9])(?=[a-z0-9_-]*[A-Z])(?=[A-Z0-9_-]*[a-z])[A-Za-z0-9_-]{16,256}(?![A-Za-z0-9+/_@-])")
ISSUED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,256}|sk-[A-Za-z0-9-]{16,256}|xox[abprs]-[A-Za-z0-9-]{10,256})(?![A-Za-z0-9])")
NUMBER = re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")
IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
FULL_NAME = re.compile(r"[A-Z][a-z]+(?: [A-Z][a-z]+){1,2}(?![A-Za-z])")
TITLED = re.compile(r"(?:(?:Mr|Mrs|Ms|Dr|Dear)\.? )+([A-Z][a-z]+(?: [A-Z][a-z]+){0,2})(?![A-Za-z])")

# Gazetteers.
KEY_WORDS = frozenset("token secret password passwd pwd key apikey api_key auth credential bearer session private".split())
PLAIN_KEYS = frozenset("http https url version path file class id hash sha md5 commit checksum".split())
TITLES = frozenset("mr mrs ms dr dear".split())
FIRST_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica"
    " thomas sarah charles karen christopher lisa daniel nancy matthew betty anthony margaret sandra mark ashley donald"
    " steven emily paul anna andrew maria peter laura hans klaus pierre jean marie jose juan carlos sofia".split()
)
NUMBER_WORDS = frozenset("card visa account ssn social security passport tax insurance iban credit debit".split())
CARD_WORDS = frozenset("card visa credit debit".split())
NAME_WORDS = frozenset("mr mrs ms dr name named contact dear sincerely regards author patient client customer".split())
CONTEXT = {"secret": KEY_WORDS, "card": NUMBER_WORDS, "id": NUMBER_WORDS, "name": NAME_WORDS}
CONTEXT_CHARS = 48

LABELERS = ("shape", "gazetteer", "context", "variety")
ROUNDS = 60
ACCEPT = 0.5
REDACTION = "[{}]"

DIGIT_OR_MARK = re.compile(r"[0-9@+=:]")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


class Candidate(NamedTuple):
    """A span that may be personal data, the labelers' votes (1, -1 or 0) and its features for the classifier."""

    span: Span
    votes: tuple[int, ...]
    features: tuple[str, ...]


class Model(NamedTuple):
    """Rates of votes for true and for false candidates of each labeler by kind, and the classifier's weights."""

    reliability: dict[tuple[str, str], tuple[float, float]]
    weights: dict[str, float]

    def probability(self, features: tuple[str, ...]) -> float:
        logit = sum(self.weights.get(f, 0.0) for f in features) + self.weights.get("", -4.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """At each @ the local part reaches back as far as its characters go, but not into an earlier match."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield Span(start, match.end(), "email")
            low = match.end()
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind; matches that fail their test are dropped."""
    found = list(emails(text))
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            found.append(Span(*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(Span(*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(Span(*m.span(), "phone"))
    return sorted(found, key=lambda s: (s.start, ORDER[s.kind]))


def words_near(text: str, start: int, end: int) -> set[str]:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS // 2]
    return set(re.findall(r"[a-z_]+", around.lower()))


def variety(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def candidate(text: str, start: int, end: int, kind: str, shape: int, listed: int) -> Candidate:
    value, near = text[start:end], words_near(text, start, end)
    context = 1 if near & CONTEXT[kind] else -1 if near & PLAIN_KEYS else 0
    bits = variety(value)
    mixed = 1 if bits >= (3.0 if kind == "secret" else 2.0) else -1
    letters, digits = any(c.isalpha() for c in value), any(c.isdigit() for c in value)
    before = re.search(r"([a-z_]+)\W*$", text[max(0, start - CONTEXT_CHARS) : start].lower())
    key = before[1] if before else ""
    left = "key" if key in CONTEXT[kind] else "plain" if key in PLAIN_KEYS else "word" if key else "none"
    features = (
        f"{kind}", f"{kind} length {min(len(value) // 8, 8)}", f"{kind} bits {min(int(bits * 2), 10)}",
        f"{kind} {'letters' * letters} {'digits' * digits}", f"{kind} left {left}", f"{kind} shape {shape}",
    )
    return Candidate(Span(start, end, kind), (shape, listed, context, mixed), features)


def candidates(text: str, names: list[int], base: list[Span]) -> list[Candidate]:
    """Candidates that touch no base span and no earlier candidate. ``names``: where words of the name list begin."""
    found = []
    for m in SECRET.finditer(text):
        start, end = m.span(1)
        value = text[start:end].rstrip(".-")
        word = re.search(r"([A-Za-z_]+)\s*$", text[max(0, m.start() - CONTEXT_CHARS) : m.start()])
        key = word[1].lower() if word else ""
        shape = 1 if re.fullmatch(r"[0-9A-Fa-f]{16,}|(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]+", value) else -1
        listed = 1 if any(w in key for w in KEY_WORDS) else -1 if key in PLAIN_KEYS else 0
        found.append(candidate(text, start, start + len(value), "secret", shape, listed))
    for pattern, listed in ((ISSUED, 1), (TOKEN, 0)):
        for m in pattern.finditer(text):
            found.append(candidate(text, *m.span(), "secret", 1, listed))
    for m in NUMBER.finditer(text):
        # Digits that fail the checksum are no card unless the words around speak of one.
        valid = luhn(m[0])
        if valid or words_near(text, *m.span()) & CARD_WORDS:
            found.append(candidate(text, *m.span(), "card", 1 if valid else -1, 1 if m[0][0] in "3456" else 0))
    for m in IDENTITY.finditer(text):
        valid = m[0][:3] not in ("000", "666") and m[0][0] != "9"
        found.append(candidate(text, *m.span(), "id", 1 if valid else -1, 0))
    for at in names:
        m, titled = FULL_NAME.match(text, at), TITLED.match(text, at)
        if titled:
            known = titled[1].split()[0].lower() in FIRST_NAMES
            found.append(candidate(text, *titled.span(1), "name", 1 if " " in titled[1] else 0, 1 if known else 0))
        elif m and m[0].split()[0].lower() in FIRST_NAMES:
            last = m[0].split()[-1]
            found.append(candidate(text, *m.span(), "name", 1 if len(last) > 1 else -1, 1))
    taken, out = sorted((s.start, s.end) for s in base), []
    for c in sorted(found, key=lambda c: (c.span.start, ORDER[c.span.kind], c.span.end)):
        if all(c.span.end <= a or b <= c.span.start for a, b in taken):
            out.append(c)
            taken.append(c.span[:2])
    return out


def name_places(words: PlainWords, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and byte position in it of every word of the name list that begins with a capital."""
    hashes = words.hashes()
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[place] == hashes)
    text = np.searchsorted(words.first, hit, side="right") - 1
    return text, words.starts[hit] - words.bounds[text]


def hashed(words: frozenset[str]) -> np.ndarray:
    return np.sort(PlainWords(pa.array(sorted(words))).hashes())


def scan(column: pa.Array, known: np.ndarray) -> Iterator[tuple[int, str, list[Span], list[Candidate]]]:
    """Base spans and candidates of the texts that have any; most texts are passed over without a look at their letters."""
    owners, places = name_places(PlainWords(column), known)
    named: dict[int, list[int]] = {}
    for owner, place in zip(owners.tolist(), places.tolist(), strict=True):
        named.setdefault(owner, []).append(place)
    marked = pc.fill_null(pc.match_substring_regex(column, "[0-9@+=:]"), False).to_numpy(zero_copy_only=False)
    for i in sorted({*np.flatnonzero(marked).tolist(), *named}):
        text = column[i].as_py()
        names = []
        if i in named:
            data = text.encode()
            names = [len(data[:p].decode()) for p in named[i]] if not text.isascii() else named[i]
        base = base_spans(text)
        yield i, text, base, candidates(text, names, base)


def reliabilities(counts: dict[tuple[str, tuple[int, ...]], int], rounds: int = ROUNDS):
    """Expectation-maximisation over vote patterns: how labelers vote on true and on false candidates, and the posterior of each pattern.

    A labeler has two rates, of votes for a true and for a false candidate, so one
    that never fails the true ones can rule a candidate out. Abstentions say
    nothing. Labelers are taken as independent given the truth.
    """
    rates, posterior = {}, {}
    for kind in sorted({k for k, _ in counts}):
        patterns = sorted(p for k, p in counts if k == kind)
        votes = np.array(patterns, float)
        weight = np.array([counts[kind, p] for p in patterns], float)
        truth = 1 / (1 + np.exp(-2 * votes.sum(1)))  # majority to begin with
        for _ in range(rounds):
            prior = (weight @ truth + 1) / (weight.sum() + 2)
            logit = np.full(len(patterns), math.log(prior / (1 - prior)))
            for j, name in enumerate(LABELERS):
                pro, cast = votes[:, j] > 0, votes[:, j] != 0
                # Each rate begins from the belief that four votes of five are right.
                of_true = (weight[pro] @ truth[pro] + 4) / (weight[cast] @ truth[cast] + 5)
                of_false = (weight[pro] @ (1 - truth[pro]) + 1) / (weight[cast] @ (1 - truth[cast]) + 5)
                of_false = min(of_false, of_true)  # a vote for a candidate never speaks against it
                rates[kind, name] = (float(of_true), float(of_false))
                logit += np.where(pro, math.log(of_true / of_false), np.where(cast, math.log((1 - of_true) / (1 - of_false)), 0.0))
            truth = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        posterior |= {(kind, p): float(t) for p, t in zip(patterns, truth, strict=True)}
    return rates, posterior


def train(rows: list[tuple[tuple[str, ...], float, int]], rounds: int = 400) -> dict[str, float]:
    """Logistic weights for (features, posterior, count) rows."""
    names = sorted({f for features, _, _ in rows for f in features})
    at = {f: i + 1 for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, 0] = 1
    for i, (features, _, _) in enumerate(rows):
        x[i, [at[f] for f in features]] = 1
    y, n = np.array([p for _, p, _ in rows]), np.array([c for _, _, c in rows], float)
    n = n / n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 2.0 * (x.T @ (n * (p - y)) + 1e-3 * w)
    return {"": float(w[0])} | {f: float(w[i]) for f, i in at.items()}


def learn(docs: DataFrame) -> Model:
    """Reliabilities and classifier from the candidates of all texts.

    Only counts by kind, votes and features travel; their number is bounded by
    the features' buckets. No candidates give a model that accepts nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = hashed(FIRST_NAMES | TITLES), Counter()
        for batch in batches:
            for part in slices(batch):
                for _, _, _, found in scan(part.column("text"), known):
                    seen.update((c.span.kind, c.votes, c.features) for c in found)
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in keys], pa.string()), pa.array([",".join(map(str, v)) for _, v, _ in keys], pa.string()),
                pa.array(["|".join(f) for _, _, f in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64()),
            ],
            names=["kind", "votes", "features", "held"],
        )

    partial = docs.select("text").mapInArrow(count, "kind string, votes string, features string, held long")
    rows = partial.groupBy("kind", "votes", "features").agg(F.sum("held").alias("held")).collect()
    rows = sorted((r["kind"], tuple(map(int, r["votes"].split(","))), tuple(r["features"].split("|")), r["held"]) for r in rows)
    if not rows:
        return Model({}, {})
    counts: Counter = Counter()
    for kind, votes, _, held in rows:
        counts[kind, votes] += held
    rates, posterior = reliabilities(counts)
    return Model(rates, train([(features, posterior[kind, votes], held) for kind, votes, features, held in rows]))


def accepted(base: list[Span], found: list[Candidate], model: Model) -> list[Span]:
    """Base spans and the candidates the classifier accepts, by start, then kind."""
    more = [c.span for c in found if model.probability(c.features) >= ACCEPT]
    return sorted([*base, *more], key=lambda s: (s.start, ORDER[s.kind], s.end))


def find_spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``found``: kind, start, end and base of every span, in code points, end exclusive.

    ``docs`` needs doc_id and text; other columns are ignored. Null and empty
    texts have no spans. Every row is searched by itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashed(FIRST_NAMES | TITLES)
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = [[] for _ in range(part.num_rows)]
                for i, _, base, found in scan(part.column("text"), known):
                    fixed = set(base)
                    rows[i] = [{"kind": s.kind, "start": s.start, "end": s.end, "base": s in fixed} for s in accepted(base, found, shared.value)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "found"])

    found = T._parse_datatype_string("found array<struct<kind:string,start:bigint,end:bigint,base:boolean>>").fields
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *found]))


def redacted(text: str, spans: list[Span]) -> str:
    """Replace each stretch covered by spans by the kind of its first span."""
    out, at = [], 0
    for span in spans:
        if span.start >= at:
            out += [text[at : span.start], REDACTION.format(span.kind.upper())]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with personal data in text replaced, and n_chars counted anew where there is one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashed(FIRST_NAMES | TITLES)
        for batch in batches:
            for part in slices(batch):
                new = {i: redacted(text, accepted(base, found, shared.value)) for i, text, base, found in scan(part.column("text"), known)}
                if not new:
                    yield part
                    continue
                texts = part.column("text").to_pylist()
                for i, text in new.items():
                    texts[i] = text
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    out = map_rows(docs, run)
    if "n_chars" in docs.columns:
        blank = F.col("text").isNull() | F.col("n_chars").isNull()
        changed = F.when(blank, F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*map(quoted, docs.columns))


def span_digest(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
