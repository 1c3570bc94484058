"""Operator 10: personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, plus-signs, digits, scheme
separators and identifier cues) in each whole text; deterministic parsers
expand an anchor to the boundaries of what it belongs to and validate it.

Base kinds, leftmost and non-overlapping within a kind:

``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
``ip``     four dotted digit runs, each at most 255
``card``   digits with single spaces or hyphens between, 12 to 19, Luhn
``phone``  ``\\+[0-9][ ().0-9-]+[0-9]`` with 9 to 15 digits

A match that fails its check is dropped and consumed. Kinds that the anchors add:
``email`` with letters beyond ASCII, ``url`` addresses that carry user data
before the host, and ``account`` identifiers and credentials behind a cue
(an IBAN must pass its check digits). Added spans may overlap base ones.

Offsets are code points, end exclusive. Null and empty texts have no spans.
Each row is read by itself: repeated rows repeat, an empty table gives none,
other columns pass through ``redact`` unchanged and are ignored by ``detect``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, packed, small_pieces, table

KINDS = ("email", "ip", "card", "phone", "url", "account")
PIECE_BYTES = 1 << 20

# Words that announce an identifier; matched whole, in any case of A-Z (the automaton reads the text in lower case).
CUES = ("account", "acct", "iban", "ssn", "passport", "token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access_key")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_WIDE_DOMAIN = re.compile(r"[\w-]++(?:\.[\w-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_RUN = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_URL_USER = re.compile(r"[^\s/@\"'<>]++@[^\s\"'<>]++")
_VALUE = re.compile(r"[ \t]{0,3}(?:number|no\.|nr\.|no|nr|id)?[ \t]{0,3}(?:[:=#]|is)?[ \t]{0,3}[\"']?", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ID = re.compile(r"[A-Za-z0-9_-]{6,}+")

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for d in "0123456789":
            a.add_word(d, "digit")
        a.add_word("@", "at")
        a.add_word("+", "plus")
        a.add_word("://", "scheme")
        for cue in CUES:
            a.add_word(cue, f"cue{len(cue)}")
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _at_most_255(run: str) -> bool:
    run = run.lstrip("0")
    return len(run) < 4 and int(run or 0) <= 255


def iban(value: str) -> bool:
    s = value.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _wide_email(text: str, at: int, floor: int, base: bool) -> tuple[int, int] | None:
    """An address with letters beyond ASCII around the at-sign at ``at``, where no base one is."""
    if base:
        return None
    i = at
    while i > floor and (text[i - 1] in _LOCAL or text[i - 1].isalnum()):
        i -= 1
    m = _WIDE_DOMAIN.match(text, at + 1)
    return (i, m.end()) if i < at and m and text[i:at].strip("._%+-") else None


def _account(text: str, begin: int, end: int) -> tuple[int, int] | None:
    if begin and (text[begin - 1].isalnum() or text[begin - 1] == "_") or text[end : end + 1].isalpha():
        return None
    at = _VALUE.match(text, end).end()
    if at == end:
        return None
    m = _IBAN.match(text, at)
    if m and iban(m[0]):
        return m.span()
    m = _ID.match(text, at)
    return m.span() if m and sum(c.isdigit() for c in m[0]) >= 4 else None


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans, as (start, kind's place in KINDS, end), sorted."""
    if not text:
        return [], []
    base, more = [], []
    mail_from = wide_from = dotted_to = card_to = phone_to = url_to = 0
    for end, what in _automaton().iter(text.lower() if text.isascii() else text.translate(_LOWER)):
        if what == "digit":
            if end >= dotted_to:
                m = _DOTTED.match(text, end)
                dotted_to = m.end()
                if m.end() - end >= 7:
                    runs = [(r.start(), r.end()) for r in _RUN.finditer(text, end, m.end())]
                    for k in range(0, len(runs) - 3, 4):
                        if all(_at_most_255(text[a:z]) for a, z in runs[k : k + 4]):
                            base.append((runs[k][0], 1, runs[k + 3][1]))
            if end >= card_to:
                m = _CARD.match(text, end)
                card_to = m.end()
                if card_to - end >= 12:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        base.append((end, 2, card_to))
        elif what == "at":
            i = end
            while i > mail_from and text[i - 1] in _LOCAL:
                i -= 1
            m = _DOMAIN.match(text, end + 1) if i < end else None
            if m:
                base.append((i, 0, m.end()))
                mail_from = wide_from = m.end()
            elif wide := _wide_email(text, end, max(mail_from, wide_from), False):
                more.append((wide[0], 0, wide[1]))
                wide_from = wide[1]
        elif what == "plus":
            if end >= phone_to and (m := _PHONE.match(text, end)):
                s = m[0].rstrip(" ().-")
                if len(s) >= 4:
                    phone_to = end + len(s)
                    if 9 <= sum(c.isdigit() for c in s) <= 15:
                        base.append((end, 3, phone_to))
        elif what == "scheme":
            i = end - 2
            while i > url_to and (text[i - 1].isascii() and text[i - 1].isalnum() or text[i - 1] in "+.-"):
                i -= 1
            m = _URL_USER.match(text, end + 1) if i < end - 2 else None
            if m:
                more.append((i, 4, m.end()))
                url_to = m.end()
        else:
            span = _account(text, end + 1 - int(what[3:]), end + 1)
            if span:
                more.append((span[0], 5, span[1]))
    return sorted(base), sorted(set(more) - set(base))


SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _spans(text: str | None) -> list[dict]:
    base, more = find(text)
    return [
        {"kind": KINDS[k], "start": a, "end": z, "base": own}
        for a, k, z, own in sorted([(*x, True) for x in base] + [(*x, False) for x in more])
    ]


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans by start, then kind as listed in KINDS."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in small_pieces(batches, "text", PIECE_BYTES):
            yield {"doc_id": b.column("doc_id"), "spans": pa.array([_spans(t) for t in b.column("text").to_pylist()], _SPAN)}

    return packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SPANS)


def masked(text: str | None) -> str | None:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    base, more = find(text)
    out, at = [], 0
    for a, k, z in sorted(base + more):
        if a < at:
            if z > at:
                at = z
            continue
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = z
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame) -> DataFrame:
    """Every row with its text masked; ``n_chars``, where present, follows the text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for b in small_pieces(batches, "text", PIECE_BYTES):
            old = b.column("text").to_pylist()
            cols = {n: b.column(n) for n in names}
            cols["text"] = new = [masked(t) for t in old]
            if "n_chars" in cols:
                cols["n_chars"] = [n if a is b or a == b else len(b) for a, b, n in zip(old, new, cols["n_chars"].to_pylist())]
            yield cols
        give_back()

    return packed(docs, run, docs.schema)


def op10(spark, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    own = "filter(spans, s -> s.base)"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(F.expr(joined.format(own)).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )
