"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, schemes, digits after which an
identifier may go on, and identifier cues; local parsers around each anchor find
the boundaries and validate them. No text is searched from every position.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import per_document

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE_KINDS = KINDS[:4]

RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

# Cues and the kind of the parser that expands them.
CUES = {"@": "email", "+": "phone", "://": "url", "iban": "iban", "account": "account", "konto": "account",
        "cuenta": "account", "compte": "account"} | {str(d): "digit" for d in range(10)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
DIGITS = frozenset("0123456789")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL_REST = re.compile(r"[^\x00-\x20\"'<>\x7f]+")
IBAN = re.compile(r"[\x20:#=]{0,4}([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]{4}){2,7}(?:\x20?[A-Za-z0-9]{1,3})?)(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?))?[\x20:#=]{1,4}([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9])", re.IGNORECASE)


def automaton() -> ahocorasick.Automaton:
    cues = ahocorasick.Automaton()
    for cue, kind in CUES.items():
        cues.add_word(cue, (kind, len(cue)))
    cues.make_automaton()
    return cues


def luhn(digits: str) -> bool:
    doubled = (d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return sum(doubled) % 10 == 0


def iban_holds(text: str) -> bool:
    plain = text.replace(" ", "").upper()
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def spans_of(text: str, cues: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, each kind's in order and apart; code points, end exclusive."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    anchors: dict[str, list[int]] = {}
    # ASCII letters only change case, so places in the folded text are places in the text.
    for end, (kind, size) in cues.iter(_folded(text)):
        anchors.setdefault(kind, []).append(end + 1 if kind in ("url", "iban", "account") else end)

    done = 0
    for at in anchors.get("email", ()):
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found["email"].append((start, m.end()))
            done = m.end()
    done = 0
    for at in anchors.get("phone", ()):
        if at >= done and (m := PHONE.match(text, at)):
            done = m.end()
            if 9 <= len(digits_of(m[0])) <= 15:
                found["phone"].append(m.span())
    _digit_kinds(text, anchors.get("digit", ()), found)
    done = 0
    for after in anchors.get("url", ()):
        start = after - 3
        while start > done and (text[start - 1] in LETTERS or text[start - 1] in DIGITS or text[start - 1] in "+.-"):
            start -= 1
        while start < after - 3 and text[start] not in LETTERS:
            start += 1
        if start < after - 3 and (m := URL_REST.match(text, after)):
            done = after + len(m[0].rstrip(".,;:!?)]}"))
            if done > after:
                found["url"].append((start, done))
    for kind, pattern, holds in (("iban", IBAN, iban_holds), ("account", ACCOUNT, lambda _: True)):
        done = 0
        for after in anchors.get(kind, ()):
            if after >= done and (m := pattern.match(text, after)) and holds(m[1]):
                found[kind].append(m.span(1))
                done = m.end()
    return found


def _digit_kinds(text: str, anchors, found: dict) -> None:
    ip_done = card_done = 0
    before = -2
    for at in anchors:
        first, before = at != before + 1, at
        # Both patterns take whole runs of digits, so a match starts where a run does.
        if not first:
            continue
        if at >= ip_done and (m := QUAD.match(text, at)):
            ip_done = m.end()
            if all(_byte(part) for part in m[0].split(".")):
                found["ip"].append(m.span())
        if at >= card_done and (m := CARD.match(text, at)):
            card_done = m.end()
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())


def _byte(part: str) -> bool:
    """At most 255, whatever the number of digits."""
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


_FOLD = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _folded(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_FOLD)


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in found[kind])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and ``RESULT`` for every row of ``docs``; a null text is empty.

    Besides the four base kinds, ``spans`` holds url (a scheme's whole address), iban
    (cue, form and check digits) and account (cue and 6 to 18 digits).
    """
    cues = automaton()

    def result(text: str) -> tuple:
        found = spans_of(text, cues)
        digest = hashlib.sha256(joined(found, BASE_KINDS).encode()).hexdigest()
        return (*(len(found[kind]) for kind in BASE_KINDS), digest, joined(found, KINDS))

    return per_document(docs, RESULT, result)


def masked_text(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span, overlapping ones as one, replaced by its first kind in brackets."""
    parts, at = [], 0
    spans = sorted((a, b, kind) for kind, pairs in found.items() for a, b in pairs)
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and ``n_chars``, if there, counted anew; null stays null."""
    cues = automaton()
    columns, schema = docs.columns, docs.schema

    def hide(batches):
        import pyarrow as pa

        where = columns.index("text")
        for batch in batches:
            texts = batch.column(where).to_pylist()
            new = [None if t is None else masked_text(t, spans_of(t, cues)) for t in texts]
            yield batch.set_column(where, batch.schema.field(where), pa.array(new, batch.schema.field(where).type))

    out = docs.mapInArrow(hide, schema)
    if "n_chars" in columns:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out
