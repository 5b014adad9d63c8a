"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

1. One scan finds, per text, the base spans (strict patterns) and wider candidates
   of each kind: spelled-out e-mail addresses, addresses with spelled or bracketed
   dots, card numbers with other separators, phone numbers without a plus.
2. Labelers vote 1, 0 (abstain) or -1 on each candidate: its strict pattern, its
   format's checks, a gazetteer, and words in the context around it. The gazetteer
   is a table (kind, entry), read as data: labels of mail domains, leading octets of
   addresses (``10`` or ``192.168``), leading digits of cards and phone numbers.
3. The counts of vote patterns over all documents, a table bounded by kinds and
   patterns, go to the driver. Expectation-maximisation estimates, by kind, the
   share of true spans and each labeler's reliability.
4. A logistic classifier for spans is trained on EM's probabilities, weighted by
   the pattern counts, from votes and the span's shape.
5. Candidates the classifier accepts become spans, where they touch no base span
   and no accepted span before them. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare_python, stored, text_slices

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "checks", "gazetteer", "context", "no_context")
CONTEXT = 40
ROUNDS = 50
ACCEPT = 0.5
# fixed values: the base patterns' character sets
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# wider candidates
AT, DOT = r"(?:@|\(at\)|\[at\]|\{at\})", r"(?:\.|\(dot\)|\[dot\]|\{dot\}|\[\.\]|\(\.\))"
ATS, DOTS = re.compile(AT, re.I), re.compile(DOT, re.I)
WIDE = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}\x20?{AT}\x20?[A-Za-z0-9-]{{1,63}}"
                        rf"(?:\x20?{DOT}\x20?[A-Za-z0-9-]{{1,63}}){{1,8}}", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9])", re.I),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[./_\xa0][0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"),
}
#: The gazetteer's size is counted before it is broadcast; a bigger one is refused.
MAX_ENTRIES = 200_000
PREFIX = 8
# fixed values: the gazetteer without a table
GAZETTEER = {
    "email": frozenset("com org net edu gov info io eu de fr es uk mail gmail yahoo outlook hotmail".split()),
    "ip": frozenset(("10", "127", "172", "192")),
    "card": frozenset(("3", "4", "5", "6")),
    "phone": frozenset(("0", "1")),
}
WORDS = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach|courriel|correo|kontakt)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login|from|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|payment|pay|carte|karte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|fax|mobile|cell|contact|téléphone|telefon|teléfono)\b", re.I),
}
AGAINST = re.compile(r"\b(?:version|isbn|issn|doi|order|invoice|serial|sku|build|chapter|figure|page)\b", re.I)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def octet(part: str) -> bool:
    """Whether digits, any number of leading zeros included, say at most 255."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text: a local part
    is the run of local characters before an at sign, back to the last span's end."""
    out, last, before = [], 0, 0
    at = text.find("@")
    while at >= 0:
        floor = max(last, before)
        part = text[floor:at]
        start = floor + len(part.rstrip(LOCAL))
        before = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Strict spans by kind, failing matches dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(map(octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return out


def wide_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text or "at)" in text or "at]" in text or "at}" in text:
        out += [("email", *m.span()) for m in WIDE["email"].finditer(text)]
    if "[" in text or "(" in text:
        out += [("ip", *m.span()) for m in WIDE["ip"].finditer(text)]
    return out + [(k, *m.span()) for k in ("card", "phone") for m in WIDE[k].finditer(text)]


def mail_labels(span: str) -> tuple[str, list[str]]:
    """Local part and lower-case domain labels of an address, spelled out or not."""
    local, _, domain = DOTS.sub(".", ATS.sub("@", span.replace(" ", ""), count=1)).partition("@")
    return local, domain.lower().split(".")


def votes(kind: str, text: str, start: int, end: int, base: bool, gazetteer: dict[str, frozenset] = GAZETTEER) -> tuple[int, ...]:
    """The labelers' votes, in the order of ``LABELERS``."""
    span, known = text[start:end], gazetteer[kind]
    near = text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]
    d = digits_of(span)
    if kind == "email":
        local, labels = mail_labels(span)
        sound = labels[-1].isalpha() and len(labels[-1]) > 1 and local.strip(".") == local and ".." not in local \
            and all(x.strip("-") == x != "" for x in labels)
        checks, gaz = 1 if sound else -1, 1 if known.intersection(labels) else 0
    elif kind == "ip":
        parts = re.findall("[0-9]+", span)
        checks = 1 if all(map(octet, parts)) else -1
        gaz = 1 if any(".".join(parts[:k]) in known for k in range(1, 5)) else 0
    elif kind == "card":
        checks = 1 if 14 <= len(d) <= 19 and luhn(d) else -1
        gaz = 1 if any(d[:k] in known for k in range(1, PREFIX + 1)) else -1
    else:
        checks = 1 if 10 <= len(d) <= 15 else -1
        gaz = 1 if base or any(d[:k] in known for k in range(1, PREFIX + 1)) else 0
    return (1 if base else 0, checks, gaz, 1 if WORDS[kind].search(near) else 0,
            -1 if AGAINST.search(near) else 0)


def shape(text: str, start: int, end: int) -> tuple[int, ...]:
    """Bounded features of a span's form: length class, neighbours, separators, case."""
    span = text[start:end]
    beside = (text[start - 1:start] if start else " ") + text[end:end + 1]
    return (min(7, (end - start) // 6), int(any(c.isalnum() for c in beside)), int(" " in span),
            int(any(c in "()[]{}" for c in span)), int(any(c.isupper() for c in span)))


def candidates(text: str | None, gazetteer: dict[str, frozenset] = GAZETTEER) -> list[dict]:
    """Base spans, then wide candidates that touch none of them, with their patterns."""
    if not text:
        return []
    base = base_spans(text)
    ends: list[tuple[int, int]] = []  # what base spans cover, merged
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if ends and a < ends[-1][1]:
            ends[-1] = (ends[-1][0], max(b, ends[-1][1]))
        else:
            ends.append((a, b))
    wide = []
    for c in wide_spans(text):
        i = bisect_left(ends, (c[2],))  # the cover before the span's end
        if not i or ends[i - 1][1] <= c[1]:
            wide.append(c)
    out = []
    for strict, spans in ((True, base), (False, wide)):
        for kind, a, b in spans:
            key = (kind, *votes(kind, text, a, b, strict, gazetteer), *shape(text, a, b))
            out.append({"kind": KINDS.index(kind), "start": a, "end": b, "base": strict,
                        "pattern": ",".join(map(str, key))})
    return out


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS):
    """``(probability of true by vote pattern, prior, reliabilities)``. Each labeler
    has, for true and for false spans, a distribution over its three votes;
    the start is the balance of the votes."""
    v = np.array([p for p, _ in patterns]).reshape(len(patterns), -1)
    n = np.array([c for _, c in patterns], float)
    q = 1 / (1 + np.exp(-v.sum(axis=1).astype(float)))
    for _ in range(rounds):
        prior = (n @ q + 1) / (n.sum() + 2)
        score = np.full(len(v), np.log(prior) - np.log1p(-prior))
        reliability = []
        for j in range(v.shape[1]):
            table = np.array([[(n * w)[v[:, j] == x].sum() + (2.0 if good else 1.0)
                               for x, good in ((-1, not true), (0, False), (1, true))]
                              for true, w in ((True, q), (False, 1 - q))])
            table /= table.sum(axis=1, keepdims=True)
            reliability.append(table)
            score += np.log(table[0, v[:, j] + 1]) - np.log(table[1, v[:, j] + 1])
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return q, prior, reliability


def train_classifier(x: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression (with a ridge) on probabilistic labels."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, share = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - target)) + 1e-3 * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _features(pattern: tuple[int, ...]) -> list[float]:
    v, s = pattern[:len(LABELERS)], pattern[len(LABELERS):]
    return [*(float(x == y) for x in v for y in (-1, 1)), *(float(s[0] == k) for k in range(8)), *map(float, s[1:])]


def fit(counts: list[tuple[str, int]]) -> dict[str, float]:
    """Probability that a span is personal data, by pattern, from the pattern counts."""
    by_kind = defaultdict(list)
    for key, n in sorted(counts):
        kind, rest = key.split(",", 1)
        by_kind[kind].append((key, tuple(map(int, rest.split(","))), n))
    out = {}
    for rows in by_kind.values():
        seen: dict[tuple, int] = defaultdict(int)
        for _, p, n in rows:
            seen[p[:len(LABELERS)]] += n
        q = dict(zip(seen, expectation_maximisation(list(seen.items()))[0]))
        x = np.array([_features(p) for _, p, _ in rows])
        target = np.array([q[p[:len(LABELERS)]] for _, p, _ in rows])
        w = train_classifier(x, target, np.array([float(n) for _, _, n in rows]))
        p = 1 / (1 + np.exp(-np.clip(np.hstack([x, np.ones((len(x), 1))]) @ w, -30, 30)))
        # no vote for a span is no evidence for it
        out |= {k: float(a) if any(v > 0 for v in pat[:len(LABELERS)]) else 0.0 for (k, pat, _), a in zip(rows, p)}
    return out


def choose(found: list[dict], probability: dict[str, float], accept: float) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of base spans and accepted candidates, sorted."""
    out = [(c["start"], c["kind"], c["end"]) for c in found if c["base"]]
    last = 0
    for c in sorted((c for c in found if not c["base"]), key=lambda c: (c["start"], c["kind"])):
        if probability.get(c["pattern"], 0.0) > accept and c["start"] >= last:
            out.append((c["start"], c["kind"], c["end"]))
            last = c["end"]
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def read_gazetteer(table: DataFrame) -> dict[str, frozenset]:
    """Entries by kind of a table (kind, entry), lower-cased; other kinds, nulls and empty entries
    count for nothing, and more than ``MAX_ENTRIES`` are refused."""
    entry = F.lower(F.trim(F.col("entry").cast("string")))
    rows = table.select(F.col("kind").cast("string").alias("kind"), entry.alias("entry")) \
        .where(F.col("kind").isin(*KINDS) & (F.col("entry") != "")).distinct().limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"a gazetteer of more than {MAX_ENTRIES} entries")
    return {k: frozenset(r["entry"] for r in rows if r["kind"] == k) for k in KINDS}


def find_spans(docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text",
               gazetteer: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``,
    one row per row of ``docs``; counts are of base spans, offsets are in code
    points. Null and empty texts have no spans (the digest of nothing). Entries of
    ``gazetteer`` (kind, entry) join the built-in ones."""
    spark = docs.sparkSession
    prepare_python(spark)
    more = read_gazetteer(gazetteer) if gazetteer is not None else {}
    known = spark.sparkContext.broadcast({k: GAZETTEER[k] | more.get(k, frozenset()) for k in KINDS})
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                      ("base", pa.bool_()), ("pattern", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "text"):
            found = [candidates(t, known.value) for t in s.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([s.column("id"), pa.array(found, pa.list_(kind))], ["id", "found"])

    found = stored(docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
                   .mapInArrow(scan, "id bigint, found array<struct<kind:int,start:bigint,end:bigint,base:boolean,pattern:string>>"),
                   "pii")
    # bounded: kinds x vote patterns x shapes
    counts = [(r[0], r[1]) for r in found.select(F.explode("found.pattern").alias("p")).groupBy("p").count().collect()]
    probability = spark.sparkContext.broadcast(fit(counts))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
        for b in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for spans in b.column("found").to_pylist():
                base = [(c["start"], c["kind"], c["end"]) for c in spans if c["base"]]
                every = choose(spans, probability.value, accept) if spans else []
                row = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                row += [hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every) - len(base)]
                for col, x in zip(cols, row):
                    col.append(x)
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, t) for c, t in zip(cols, types))], names)

    return found.mapInArrow(decide, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                    "base_sha256 string, spans string, n_added bigint")
