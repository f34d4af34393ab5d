"""Personal data by anchor expansion (operator 4).

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and
identifier cues.  A deterministic parser per kind expands each anchor to the boundaries of a
candidate and validates it (octet range, check digit, digit count).  Text without anchors costs
nothing beyond that pass.

Kinds: email, ip, card and phone follow fixed patterns, leftmost and non-overlapping per kind; a
candidate that fails its check is dropped together with its characters, without another try
inside it.  The further kinds are ssn (3-2-4 digits), login (user data before the at-sign of a
URL), iban (after its cue, mod 97) and secret (a long value assigned to a token or key cue).

Offsets count code points, end exclusive.  The work is map-only: rows are read, searched and
written in Arrow batches, nothing is shuffled.  Defined cases: NULL text counts as empty (no
spans; ``redact`` leaves it NULL); repeated rows give equal results; an empty table gives an empty
result; extra columns pass through ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "ssn", "login", "iban", "secret"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOGIN = re.compile(r"[^\s/@?#]+(?=@)")
IBAN = re.compile(r"[\s:#]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SECRET = re.compile(r"[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_/+=-]{16,})")
# Cues in front of secrets.
SECRET_CUES = ["token", "secret", "password", "passwd", "api_key", "apikey", "access_key"]


def luhn(digits: str) -> bool:
    """Whether the digits end in the check digit of the mod-10 rule."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    flat = text.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def anchors():
    """The automaton; payloads are (anchor class, length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in DIGITS:
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in SECRET_CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("secret", len(form)))
    for form in ("IBAN", "Iban", "iban"):
        found.add_word(form, ("iban", 4))
    found.make_automaton()
    return found


def find_spans(text: str | None, automaton) -> list[tuple[int, int, int]]:
    """(start, kind index in ``KINDS``, end) of all spans of one text, sorted."""
    if not text:
        return []
    spans: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)  # where the search of each kind goes on

    def take(kind: int, start: int, end: int, good: bool) -> None:
        done[kind] = end
        if good:
            spans.append((start, kind, end))

    for last, (what, size) in automaton.iter(text):
        at = last + 1 - size
        if what == "digit":
            fresh = at == 0 or text[at - 1] not in DIGITS
            if fresh and at >= done[1] and (m := IP.match(text, at)):
                take(1, at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
                                         for p in m[0].split(".")))
            if at >= done[2] and (m := CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                take(2, at, m.end(), 12 <= len(digits) <= 19 and luhn(digits))
            if fresh and at >= done[4] and (at == 0 or text[at - 1] != "-") and (m := SSN.match(text, at)):
                take(4, at, m.end(), m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000")
        elif what == "at":
            start = at
            while start > done[0] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                take(0, start, m.end(), True)
        elif what == "plus":
            if at >= done[3] and (m := PHONE.match(text, at)):
                take(3, at, m.end(), 9 <= sum(c in DIGITS for c in m[0]) <= 15)
        elif what == "scheme":
            if last + 1 >= done[5] and (m := LOGIN.match(text, last + 1)):
                take(5, m.start(), m.end(), True)
        elif what == "iban":
            if last + 1 >= done[6] and (m := IBAN.match(text, last + 1)):
                take(6, m.start(1), m.end(1), _iban_ok(m[1]))
        elif last + 1 >= done[7] and (m := SECRET.match(text, last + 1)):
            take(7, m.start(1), m.end(1), True)
    return sorted(spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, spans) per row; spans: array of (kind, start, end) by start, then kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_spans(t, automaton)]
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], [id_col, "spans"])

    id_type = dict(docs.dtypes)[id_col]
    return docs.select(id_col, "text").mapInArrow(
        run, f"`{id_col}` {id_type}, spans array<struct<kind:string,start:int,end:int>>")


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its first kind."""
    out, upto = [], 0
    for start, kind, end in spans:
        if start >= upto:
            out.append(text[upto:start])
            out.append(f"[{KINDS[kind].upper()}]")
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and an ``n_chars`` column kept in step."""
    schema, names = docs.schema, docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            cols = list(batch.columns)
            texts = cols[at].to_pylist()
            found = [find_spans(t, automaton) for t in texts]
            if any(found):
                texts = [mask(t, s) if s else t for t, s in zip(texts, found)]
                cols[at] = pa.array(texts, cols[at].type)
                if chars is not None:
                    cols[chars] = pa.array([len(t) if s else n for t, s, n in zip(
                        texts, found, cols[chars].to_pylist())], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, schema)
