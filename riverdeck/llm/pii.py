"""Personal data: fixed patterns, and what a skip-chain conditional random field adds to them.

The base patterns give spans of four kinds. Candidates are those spans, runs of seven or more digits
(or the known numbers in a run, and what lies between them), in documents with an address those spelled with
"at" and "dot", and handles with a digit that equal an address's local part. The
model (`skip_chain`) keeps base spans as they are and labels the other candidates: a number written
another way is a phone number where the same digits stand elsewhere in the document as one.
Its weights are fitted on the candidates of about `SAMPLE_DOCS` documents, at most `SAMPLE_NODES` of
them, labelled by the base patterns and by agreement within the document. Everything else sees every row.

One pass over the rows, no shuffle. Time is linear in the text for all patterns: none is tried from
each place of a run. Positions are code points, ends are exclusive.

Defined cases: a null text has no spans (redaction leaves it null); an empty text likewise; repeated
rows are separate rows; an empty table gives an empty result. Finding reads doc_id and text only;
`redact` keeps all other columns, whatever their names, and sets n_chars to the new length where present.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm import skip_chain
from riverdeck.llm.columns import hashed_share
from riverdeck.llm.shipping import ship
from riverdeck.llm.skip_chain import FEATURES, KINDS, Weights

SAMPLE_DOCS = 4000
SAMPLE_NODES = 20_000
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_AREA = re.compile(r"[0-9][0-9 ().+-]*")  # every number pattern lies in one of these, but for a phone's first plus
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?[0-9][0-9 ().-]*")
_SPELLED = re.compile(
    r"[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63})+")
_AT = re.compile(r" ?(?:\(at\)|\[at\]| at ) ?")
_DOT = re.compile(r" ?(?:\.|\(dot\)|\[dot\]| dot ) ?")
_HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{5,64}(?![A-Za-z0-9._%+@-])")
#: Words that announce a kind.
CUES = {"email": ("mail", "email", "e-mail"), "ip": ("ip", "host", "server"), "card": ("card", "visa", "credit"),
        "phone": ("phone", "tel", "call", "mobile", "fax")}
_CUE = {word: kind for kind, words in CUES.items() for word in words}


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match has one `@`; it starts as far to the left as the local part's characters reach."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in that order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for area in _AREA.finditer(text):
        begin, end = area.span()
        if end - begin < 7:
            continue  # shorter than any match
        for chain in _DOTTED.finditer(text, begin, end):
            parts, start = chain[0].split("."), chain.start()
            for k in range(0, len(parts) - 3, 4):
                own = parts[k:k + 4]
                stop = start + sum(map(len, own)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                    found.append((start, 1, stop))
                start = stop + 1
        for card in _CARD.finditer(text, begin, end):
            digits = digits_of(card[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((card.start(), 2, card.end()))
    if "+" in text:
        for phone in _PHONE.finditer(text):
            if 9 <= len(digits_of(phone[0])) <= 15:
                found.append((phone.start(), 3, phone.end()))
    return sorted(found)


def _keys(kind: int, piece: str) -> tuple[str, ...]:
    """What a candidate may have in common with others: an address, its local part, its digits, the end of a number."""
    if kind == 0:
        address = re.sub(r" ?(?:\(dot\)|\[dot\]| dot ) ?", ".", piece.lower())
        address = re.sub(r" ?(?:\(at\)|\[at\]| at ) ?", "@", address).replace(" ", "")
        local = address.partition("@")[0]
        return (address, local) if len(local) >= 5 and re.search("[0-9]", local) else (address,)
    digits = digits_of(piece)
    if kind == 1:
        return ("." + piece,)
    return (digits, "~" + digits[-9:]) if 9 <= len(digits) <= 15 else (digits,)


def _number_ends(keys: Iterable[tuple[str, ...]]) -> set[str]:
    """The digits of known numbers: whole, and where the last nine count, each end of nine or more."""
    ends = set()
    for own in keys:
        ends.add(own[0])
        if len(own) > 1:
            ends.update((own[0][k:] for k in range(1, len(own[0]) - 8)), own[1:])
    return ends


def _numbers_in(text: str, start: int, end: int, numbers: set[str]) -> list[tuple[int, int]]:
    """The run itself where it is one number: alone, or the same as a known one. Else the known numbers in it, cut
    where its digits are parted, and what lies between them."""
    groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", text[start:end])]
    digits = digits_of(text[start:end])
    if len(groups) == 1 or not numbers or not numbers.isdisjoint(_keys(3, digits)):
        return [(start, end)]
    cuts = [0]  # where each group starts among the digits
    for low, high in groups:
        cuts.append(cuts[-1] + high - low)
    out, done = [], 0

    def rest(upto: int) -> None:
        if cuts[upto] - cuts[done] >= 7:
            out.append((start + groups[done][0], start + groups[upto - 1][1]))

    for last in range(len(groups)):
        stop, best = cuts[last + 1], -1
        for first in range(last, done - 1, -1):
            n = stop - cuts[first]
            if n > 19:
                break
            if n >= 9 and digits[cuts[first]:stop] in numbers:
                best = first  # the longest that is a known number or an end of one
            elif best < 0 and 9 <= n <= 15 and "~" + digits[stop - 9:stop] in numbers:
                best = first  # with another prefix
        if best >= 0:
            rest(best) if best > done else None
            out.append((start + groups[best][0], start + groups[last][1]))
            done = last + 1
    if done < len(groups):
        rest(len(groups))
    return out if done else [(start, end)]


def _address_end(spelled: re.Match, addresses: set[str], labels: set[int]) -> int:
    """Where a spelled address ends: after the labels that make a known one, since "x dot org. Then" reads on."""
    whole = _keys(0, spelled[0])[0]
    if whole not in addresses:
        local, _, domain = whole.partition("@")
        parts = domain.split(".")
        borders = [m.start() for m in _DOT.finditer(spelled[0], _AT.search(spelled[0]).end())]
        for n in sorted(labels, reverse=True):
            if n < len(borders) and f"{local}@{'.'.join(parts[:n + 1])}" in addresses:
                return spelled.start() + borders[n]
    return spelled.end()


def _apart(others: list) -> list:
    """Of overlapping ones the first, then the longest."""
    out, reach = [], 0
    for other in sorted(others, key=lambda o: (o[0], -o[1])):
        if other[0] >= reach:
            out.append(other)
            reach = other[1]
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, tuple[str, ...], int]]:
    """(start, end, shape, keys, base kind or -1), by start. Shapes are kind numbers; spelled addresses
    and handles have 0, other numbers 3. None but base spans overlaps a base span."""
    found = [(s, e, kind, _keys(kind, text[s:e]), kind) for s, kind, e in base]
    covered = sorted((s, e) for s, _, e in base)
    gaps, at = [], 0
    for s, e in [*covered, (len(text), len(text))]:
        if s > at:
            gaps.append((at, s))
        at = max(at, e)
    addresses = {f[3][0] for f in found if f[4] == 0}
    labels = {address.count(".", address.find("@")) for address in addresses}
    locals_ = {key for f in found if f[4] == 0 for key in f[3][1:]}
    numbers = _number_ends(f[3] for f in found if f[4] > 1)
    others = []
    for low, high in gaps:
        for run in _NUMBER.finditer(text, low, high):
            piece = run[0].rstrip(" ().-+")
            if len(piece) >= 7 and len(digits_of(piece)) >= 7:
                others += [(s, e, 3, _keys(3, text[s:e]), -1)
                           for s, e in _numbers_in(text, run.start(), run.start() + len(piece), numbers)]
        if addresses:  # only where an address stands can another spelling agree with one
            others += [(m.start(), e, 0, _keys(0, text[m.start():e]), -1) for m in _SPELLED.finditer(text, low, high)
                       for e in [_address_end(m, addresses, labels)]]
        if locals_:
            others += [(*m.span(), 0, (m[0].lower(),), -1) for m in _HANDLE.finditer(text, low, high)
                       if m[0].lower() in locals_]
    # Of overlapping ones those that agree with a base span, then the first, then the longest.
    known = {key for f in found for key in f[3]}
    agree = [not known.isdisjoint(o[3]) for o in others]
    taken = _apart([o for o, own in zip(others, agree) if own])
    found += taken
    starts = [o[0] for o in taken]

    def free(other) -> bool:
        after = bisect_left(starts, other[1])  # those before it start ahead of its end
        return after == 0 or taken[after - 1][1] <= other[0]

    found += _apart([o for o, own in zip(others, agree) if not own and free(o)])
    return sorted(found)


def _features(text: str, start: int, end: int) -> list[float]:
    piece = text[start:end]
    digits = digits_of(piece)
    n = len(digits)
    word = re.search(r"([A-Za-z-]+)[^A-Za-z0-9]{0,3}$", text[max(0, start - 24):start])
    cue = _CUE.get(word[1].lower()) if word else None
    return [1.0, "@" in piece or " at " in piece or "(at)" in piece or "[at]" in piece, piece[0] == "+",
            piece.count(".") == 3, 12 <= n <= 19 and luhn(digits), n < 9, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19,
            n > 19, any(c.isalpha() for c in piece), *[cue == kind for kind in KINDS]]


def _node_features(text: str, found: list) -> np.ndarray:
    return np.array([_features(text, f[0], f[1]) for f in found], float).reshape(-1, len(FEATURES))


def find(text: str, weights: Weights = skip_chain.PRIOR) -> list[tuple[str, int, int, bool]]:
    """All spans of a text: (kind, start, end, whether a base pattern gave it), by start, then kind."""
    base = base_spans(text)
    spans = [(s, kind, e, True) for s, kind, e in base]
    found = candidates(text, base) if base or _AREA.search(text) else []
    if len(found) > len(base):
        known = [f[4] + 1 if f[4] >= 0 else -1 for f in found]
        p = skip_chain.marginals(_node_features(text, found), known, skip_chain.skip_edges([f[3] for f in found]),
                                 weights)
        for f, label, own in zip(found, p.argmax(1), p):
            if f[4] < 0 and label > 0 and own[label] > 0.5:
                spans.append((f[0], int(label) - 1, f[1], False))
    return [(KINDS[kind], s, e, is_base) for s, kind, e, is_base in sorted(spans)]


def training_rows(text: str) -> list[dict]:
    """A candidate per row, labelled by the base patterns, or by a base span that shares a key."""
    found = candidates(text, base_spans(text))
    if not found:
        return []
    of_key = {key: f[4] + 1 for f in found if f[4] >= 0 for key in f[3]}
    labels = [f[4] + 1 if f[4] >= 0 else max([of_key.get(key, 0) for key in f[3]]) for f in found]
    linked = np.zeros((len(found), 5))
    for a, b in skip_chain.skip_edges([f[3] for f in found]):
        linked[a, labels[b]] += 1
        linked[b, labels[a]] += 1
    return [{"features": list(map(float, x)), "label": labels[k], "before": labels[k - 1] if k else -1,
             "after": labels[k + 1] if k + 1 < len(found) else -1, "linked": list(linked[k]), "start": found[k][0]}
            for k, x in enumerate(_node_features(text, found))]


def fit_weights(docs: DataFrame) -> Weights:
    """Weights from a bounded sample: documents by a hash of doc_id, then the first candidates by hash."""
    ship(docs.sparkSession)
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    chosen = docs.select(F.xxhash64("doc_id").alias("hash"), "text").filter(hashed_share(F.col("hash"), share))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [{"hash": h, **row} for h, t in zip(batch["hash"], batch["text"]) if t for row in training_rows(t)]
            yield pd.DataFrame(own, columns=["hash", "features", "label", "before", "after", "linked", "start"])

    nodes = chosen.mapInPandas(rows, "hash bigint, features array<double>, label int, before int, after int, "
                                     "linked array<double>, start int")
    sample = nodes.orderBy(F.xxhash64("hash", "start"), "hash", "start").limit(SAMPLE_NODES).collect()
    if not sample:
        return skip_chain.PRIOR
    column = lambda name, kind: np.array([row[name] for row in sample], kind)
    return skip_chain.fit(column("features", float), column("label", int), column("before", int),
                          column("after", int), column("linked", float))


def spans_of(weights: Weights):
    """A Column function: the spans of a text."""
    @F.pandas_udf(SPAN)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "base"), s)) for s in find(t, weights)] if t else []
                          for t in texts], dtype=object)

    return of


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, spans."""
    weights = fit_weights(docs)
    return docs.select("doc_id", spans_of(weights)("text").alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans as kind:start:end."""
    found = find_personal_data(docs)
    spans = F.col("spans")
    return found.select(
        "doc_id", *[_count(spans, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def redacted(text: str, weights: Weights) -> str:
    """The text with each span replaced by its kind; overlapping spans by the first one's."""
    out, at = [], 0
    for kind, start, end, _ in find(text, weights):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents without the personal data found in them."""
    weights = fit_weights(docs)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t, weights) if t else t for t in texts], dtype=object)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
