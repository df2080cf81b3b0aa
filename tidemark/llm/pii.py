"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them and teaches a span classifier."""

from __future__ import annotations

import bisect
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, materialise, table

#: Kinds whose plain patterns decide, and kinds that only the method finds.
BASE, MORE = ("email", "ip", "card", "phone"), ("ssn", "iban", "name")
KINDS = BASE + MORE
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
#: A span that no pattern decides is added from this probability on.
THRESHOLD = 0.9
#: Characters around a span that the context labeler reads, and rows passed on at once.
AROUND, ROWS = 48, 500

# Top-level domains, calling codes, starts of card and IBAN numbers, titles, given names, words in context.
DOMAINS = frozenset("com org net edu gov info io eu de fr es it uk us ch at be nl pl pt se no dk fi ie ca au jp br in".split())
CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 61 64 81 82 86 90 91 351 352 353 358 420".split())
CARDS = tuple("34 36 37 38 4 51 52 53 54 55 6011 62 65 22 23 24 25 26 27".split())
BANKS = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SK".split())
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Sr Sra Señor Señora".split()
GIVEN = (
    "James John Robert Michael William David Richard Joseph Thomas Mary Patricia Jennifer Linda Elizabeth Barbara Susan Sarah "
    "Hans Peter Klaus Jürgen Wolfgang Anna Ursula Monika Petra Sabine Pierre Jean Michel Philippe Marie Nathalie Isabelle Sophie "
    "José Antonio Manuel Francisco Carlos María Carmen Josefa Isabel Laura"
).split()
CONTEXT = {
    "email": "mail email e-mail contact kontakt correo courriel write schreiben",
    "ip": "ip host server address adresse login client from",
    "card": "card visa mastercard credit karte kreditkarte carte tarjeta payment",
    "phone": "phone tel telephone call mobile fax telefon anruf téléphone appelez teléfono llame contact",
    "ssn": "ssn social security",
    "iban": "iban account konto compte cuenta bank transfer",
    "name": "name signed regards dear sincerely author contact von by",
}
AGAINST = "version v order invoice isbn issn doi article chapter page section release build rfc port ratio score".split()

_CONTEXT = {k: frozenset(v.split()) for k, v in CONTEXT.items()}
_AGAINST = frozenset(AGAINST)
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = re.compile(r"[\[({<] ?(?:at|AT) ?[\])}>]")
_MASKED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[({<] ?(?:at|AT) ?[\])}>] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|[\[({<] ?(?:dot|DOT) ?[\])}>]) ?[A-Za-z0-9-]{1,63}){1,8}"
)
#: Digits in groups, from which national phone and social security numbers are taken.
_GROUPS = re.compile(r"[0-9]{2,5}[ ()/.-][ ()/.0-9-]{5,24}[0-9]")
_NATIONAL = re.compile(r"[0-9]{2,5}\)?[ /.-]{1,2}[0-9]{3,4}[ .-][0-9]{3,5}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
_UPPER = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,24}"
_NAME = re.compile(rf"(?:(?:{'|'.join(TITLES)})\.? {_UPPER}(?:[ -]{_UPPER}){{0,2}}|(?:{'|'.join(GIVEN)}) {_UPPER})(?![a-zß-öø-ÿ])")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,24}")
_FIRST = frozenset(TITLES) | frozenset(GIVEN)
_WORDS = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Matches of the email pattern, from one at-sign to the next, so a long text without any takes no time."""
    done, at = 0, text.find("@")
    while at >= 0:
        found, start = _DOMAIN.match(text, at + 1), at
        if found:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            done = found.end()
            yield start, done, True
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four numbers between dots, and whether none is above 255. A longer chain holds one for each four of its numbers."""
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        at, numbers = chain.start(), chain[0].split(".")
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            end = at + sum(map(len, four)) + 3
            yield at, end, all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four)
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            yield m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15


_SCANS = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


@dataclass(frozen=True)
class Candidate:
    """A place that may be personal data. ``strict``: by its kind's own pattern; ``valid``: its checks hold (None: has none)."""

    kind: str
    start: int
    end: int
    strict: bool
    valid: bool | None


class Cover:
    """Stretches of a text, overlapping ones joined, that tell at once whether another one overlaps any."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        i = bisect.bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def add(self, start: int, end: int) -> None:
        i = bisect.bisect_right(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def candidates(text: str) -> list[Candidate]:
    """Matches of the plain patterns, failed ones included, and looser ones that overlap none of those that hold."""
    plain = [Candidate(k, a, b, True, ok) for k, scan in _SCANS.items() for a, b, ok in scan(text)]
    cover = Cover([(c.start, c.end) for c in plain if c.valid])
    return plain + [c for c in _loose(text) if not cover.meets(c.start, c.end)]


def _loose(text: str) -> list[Candidate]:
    out = []
    if _AT.search(text):
        out += [Candidate("email", m.start(), m.end(), False, None) for m in _MASKED.finditer(text)]
    for group in _GROUPS.finditer(text):
        for kind, pattern in (("ssn", _SSN), ("phone", _NATIONAL)):
            if found := pattern.fullmatch(group[0]):
                start = group.start() - (kind == "phone" and ")" in found[0] and text[group.start() - 1 : group.start()] == "(")
                digits = _digits(found[0])
                ok = digits[:3] not in ("000", "666") and digits[0] != "9" if kind == "ssn" else 9 <= len(digits) <= 12
                out.append(Candidate(kind, start, group.end(), kind == "ssn", ok))
    for m in _IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        out.append(Candidate("iban", m.start(), m.end(), True, int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1))
    done = 0
    for first in _CAPITAL.finditer(text):
        if first[0] in _FIRST and first.start() >= done and (m := _NAME.match(text, first.start())):
            done = m.end()
            out.append(Candidate("name", m.start(), m.end(), False, None))
    return out


def _gazetteer(kind: str, span: str) -> int:
    digits = _digits(span)
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]}>"))[-1].lower() in DOMAINS else -1
    if kind == "ip":
        return -1 if digits.startswith("0") else 0
    if kind == "card":
        return 1 if digits.startswith(CARDS) else -1
    if kind == "phone":
        return (1 if digits.startswith(CALLING) else -1) if span.startswith("+") else 0
    if kind == "iban":
        return 1 if span[:2] in BANKS else -1
    if kind == "name":
        return 1 if any(w in GIVEN for w in span.split()) else 0
    return 0


def votes(text: str, c: Candidate) -> tuple[int, ...]:
    """What each of LABELERS says: 1 for, -1 against, 0 nothing."""
    near = {w.lower() for w in _WORDS.findall(text[max(0, c.start - AROUND) : c.start] + " " + text[c.end : c.end + AROUND // 2])}
    context = 1 if near & _CONTEXT[c.kind] else -1 if near & _AGAINST else 0
    before, after = text[c.start - 1 : c.start], text[c.end : c.end + 1]
    glued = before.isalnum() or after.isalnum() or before in ("_", "#", "$") and before != "" or after == "_"
    edges = -1 if glued else 1 if before in (":", "<", "(") and before != "" else 0
    check = 0 if c.valid is None else 1 if c.valid else -1
    return 1 if c.strict else 0, check, _gazetteer(c.kind, text[c.start : c.end]), context, edges


def _side(ch: str) -> int:
    return 0 if ch == "" or ch.isspace() else 1 if ch.isalnum() else 2 if ch in "\"'<>()[]{}" else 3 if ch in ":=|" else 4


#: Values that a pattern code packs: votes of each labeler, a size, the kinds of character before and after the span.
SIZES, SIDES = (8, 16, 32), 5
CODES = 3 ** len(LABELERS) * (len(SIZES) + 1) * SIDES * SIDES


def coded(text: str, c: Candidate) -> int:
    code = 0
    for v in votes(text, c):
        code = code * 3 + v + 1
    code = code * (len(SIZES) + 1) + sum(c.end - c.start > s for s in SIZES)
    code = code * SIDES + _side(text[c.start - 1 : c.start])
    return code * SIDES + _side(text[c.end : c.end + 1])


def decoded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pattern codes the votes, 0 to 2, and the other features as columns of zeros and ones."""
    rest, parts = codes.copy(), []
    for base in (SIDES, SIDES, len(SIZES) + 1):
        parts.append(np.eye(base)[rest % base])
        rest = rest // base
    said = np.empty((len(codes), len(LABELERS)), dtype=np.int64)
    for i in reversed(range(len(LABELERS))):
        said[:, i] = rest % 3
        rest = rest // 3
    return said, np.concatenate(parts, axis=1)


#: What a labeler is taken to say (against, nothing, for) of spans that are personal data and of others, in counts of
#: candidates. Data outweigh it; without data it stands.
_TRUE, _FALSE = np.array([2.0, 12.0, 26.0]), np.array([20.0, 16.0, 4.0])
ROUNDS, STEPS = 60, 25


class Model:
    """For each kind weights of the votes and features of a pattern code: the log-odds that a span is personal data.

    ``fit`` is given all pattern codes of a kind with their counts. Expectation-maximisation finds how often each
    labeler says what of true and false spans. Its posteriors are the targets of a logistic classifier over votes and
    surface features, whose weights start from, and are drawn to, those that the labelers' reliabilities give.
    """

    def __init__(self) -> None:
        self.weights: dict[str, np.ndarray] = {}
        self.reliabilities: dict[str, np.ndarray] = {}

    @staticmethod
    def _inputs(codes: np.ndarray) -> np.ndarray:
        said, more = decoded(codes)
        return np.concatenate([np.ones((len(codes), 1)), (said == 0).astype(float), (said == 2).astype(float), more], axis=1)

    def fit(self, kind: str, codes: np.ndarray, counts: np.ndarray) -> Model:
        said, _ = decoded(codes)
        heard = np.eye(3)[said]  # pattern, labeler, vote
        prior = np.stack([_FALSE, _TRUE])
        says = np.repeat((prior / prior.sum(axis=1, keepdims=True))[:, None, :], len(LABELERS), axis=1)
        share = 0.5
        for _ in range(ROUNDS):
            true = self._posterior(heard, says, share)
            for y, weight in enumerate((counts * (1 - true), counts * true)):
                seen = prior[y] + np.einsum("p,plv->lv", weight, heard)
                says[y] = seen / seen.sum(axis=1, keepdims=True)
            share = (5 + (counts * true).sum()) / (10 + counts.sum())
        true = self._posterior(heard, says, share)
        odds = np.log(says[1] / says[0])
        start = np.zeros(self._inputs(codes[:0]).shape[1])
        start[0] = np.log(share / (1 - share)) + odds[:, 1].sum()
        n = len(LABELERS)
        start[1 : 1 + n], start[1 + n : 1 + 2 * n] = odds[:, 0] - odds[:, 1], odds[:, 2] - odds[:, 1]
        self.reliabilities[kind], self.weights[kind] = says, self._taught(codes, counts, true, start)
        return self

    @staticmethod
    def _posterior(heard: np.ndarray, says: np.ndarray, share: float) -> np.ndarray:
        false, true = (np.einsum("plv,lv->p", heard, np.log(s)) for s in says)
        return 1 / (1 + np.exp(np.clip(false - true + np.log((1 - share) / share), -500, 500)))

    def _taught(self, codes: np.ndarray, counts: np.ndarray, true: np.ndarray, start: np.ndarray) -> np.ndarray:
        x, w = self._inputs(codes), start.copy()
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            slope = x.T @ (counts * (p - true)) + (w - start)
            bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            w = w - np.linalg.solve(bend, slope)
        return w

    def probability(self, kind: str, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._inputs(codes) @ self.weights[kind], -500, 500)))


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_PLACE = {"kind": T.StringType(), "start": T.LongType(), "end": T.LongType()}
SPAN = _struct(**_PLACE, score=T.DoubleType(), base=T.BooleanType())
_HELD = _struct(**_PLACE, code=T.IntegerType(), base=T.BooleanType(), valid=T.BooleanType())
_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("code", pa.int32()), ("base", pa.bool_()), ("valid", pa.bool_())])


def _searched(batches: Iterator[pa.RecordBatch], names: list[str], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            ends, columns = [0], [[] for _ in range(_FOUND.num_fields)]
            for value in batch.column(batch.num_columns - 1):
                text = value.as_py() or ""
                for c in candidates(text):
                    base = c.kind in BASE and c.strict and bool(c.valid)
                    for column, v in zip(columns, (c.kind, c.start, c.end, coded(text, c), base, c.valid is not False)):
                        column.append(v)
                ends.append(len(columns[0]))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _FOUND)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, fields=list(_FOUND)))
            kept = batch.columns if keep_text else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=names)


def taught(found: DataFrame, column: str) -> Model:
    """The model of all candidates. What reaches the driver is a count for each kind and pattern code: KINDS x CODES at most."""
    patterns = found.select(F.explode(column).alias("c")).groupBy("c.kind", "c.code").agg(F.count("*").alias("n")).toPandas()
    model = Model()
    for kind in KINDS:
        mine = patterns[patterns["kind"] == kind].sort_values("code")
        model.fit(kind, mine["code"].to_numpy(np.int64), mine["n"].to_numpy(np.float64))
    return model


def _chosen(spans: list[dict], model: Model, threshold: float) -> list[dict]:
    """All base spans, and of the others, best first, those likely enough that overlap none that is in."""
    out, rest = [], []
    for s in spans:
        score = float(model.probability(s["kind"], np.array([s["code"]]))[0])
        (out if s["base"] else rest).append({"kind": s["kind"], "start": s["start"], "end": s["end"], "score": score, "base": s["base"], "ok": s["valid"]})
    good = sorted((s for s in rest if s["ok"] and s["score"] >= threshold), key=lambda s: (-s["score"], s["start"], -s["end"], KINDS.index(s["kind"])))
    if good:
        taken = Cover([(s["start"], s["end"]) for s in out])
        for s in good:
            if not taken.meets(s["start"], s["end"]):
                taken.add(s["start"], s["end"])
                out.append(s)
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def with_spans(docs: DataFrame, threshold: float = THRESHOLD, keep_text: bool = False, text: str = "text", spans: str = "pii") -> DataFrame:
    """Each row of ``docs``, without its text unless ``keep_text``, with ``pii``: its spans by start and then KINDS.

    A span has a kind, places (code points from zero, the end exclusive), a score and whether a plain pattern decided it;
    such ones always stay. Others are added from ``threshold`` on, unless their own check fails or they overlap a better
    one. Labelers, classifier and counts cover all candidates of all rows.

    Null and empty texts have no spans; rows that repeat have equal ones; whole texts are read, a few at a time. An empty
    table gives an empty result. A column named like ``spans`` is replaced, all others stay.
    """
    source, column = fresh(docs, "_text_", "_found_")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() != spans.lower()]
    rows = docs.select(*kept, F.col(text).alias(source))
    names = [c for c in rows.columns if keep_text or c != source] + [column]
    schema = T.StructType([f for f in rows.schema if f.name in names]).add(column, T.ArrayType(_HELD))
    found = materialise(rows.mapInArrow(lambda b: _searched(b, names, keep_text), schema), "pii-candidates")
    model = taught(found, column)
    out = T.StructType([f for f in schema if f.name != column]).add(spans, T.ArrayType(SPAN))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                told = [_chosen(s, model, threshold) if s else [] for s in batch.column(batch.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(told, kinds)], names=out.names)

    done = found.mapInArrow(judged, out)
    return done.select(*[F.col(f"`{source}`").alias(text) if c == source else F.col(f"`{c}`") for c in done.columns])


def redacted(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", spans: str = "pii") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets, where spans overlap by the first one's; a null text stays."""
    full = with_spans(docs, threshold, True, text, spans)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    cut = lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    done = F.aggregate(
        spans,
        start,
        lambda s, p: F.when(p["start"] < s["at"], F.struct(s["out"].alias("out"), F.greatest(s["at"], p["end"]).alias("at"))).otherwise(
            F.struct(F.concat(s["out"], cut(s["at"], p["start"]), F.lit("<"), p["kind"], F.lit(">")).alias("out"), p["end"].alias("at"))
        ),
        lambda s: F.concat(s["out"], cut(s["at"], F.length(text))),
    )
    new = F.when(F.size(spans) > 0, done).otherwise(F.col(text)).alias(text)
    return full.select(*[new if c == text else F.col(f"`{c}`") for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: its base spans by kind and as a digest, and all of its spans."""
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])
    counts = [F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans")
    )
