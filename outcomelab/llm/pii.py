"""Personal data in texts, disguised forms included, with source offsets.

Base detection works on the text as it stands.  For disguised forms a chain
of three transducers rewrites the text while it keeps, for every character
of its output, the span of source characters that the character came from:

1. homoglyphs: full-width, mathematical, Greek and Cyrillic look-alikes and
   decimal digits of other scripts become their ASCII characters;
2. at/dot disguises, each rewritten for itself, so forms may be mixed:
   ``(at)``, ``[@]``, ``[dot]``, ``[.]`` and `` dot `` between words become
   ``@`` and ``.``; `` at `` does so before a host with a disguised dot (before
   a plain host name it is ordinary prose);
3. spelled digits: runs of three or more spelled-out digits become digits, and so do
   four groups of up to three of them with a dot, spelled or not, in between.

The detectors run again on the result, and each identifier is mapped back to
the source characters under it.  A mapped span is added unless a base span of
its kind covers it: base spans always stay, and a disguise that reaches further than
the base span inside it (``john dot smith@host.com``) is added as a whole.

The pass is one narrow Arrow pass over whole texts; every scan is linear in
the text, also for runs of one character class that are megabytes long.

Defined results.  A null text counts as empty and has no spans.  Null and
repeated ids are kept, one result row per input row.  Columns other than the
id and the text are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import id_type, text_or_empty, worker_cache

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.  Possessive runs and the look-behind only
# spare retries that cannot succeed.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Look-alikes of ASCII letters beyond compatibility forms.
_CYRILLIC = dict(zip("АВЕКМНОРСТХаекморстухіјѕԁһ", "ABEKMHOPCTXaekmopctyxijsdh"))
_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχω", "ABEZHIKMNOPTYXaiknoptuxw"))
_SIGNS = dict.fromkeys("\u2010\u2011\u2012\u2013\u2212", "-") | dict.fromkeys("\u2024\u3002\uff0e\ufe52", ".") | {"\ufe6b": "@", "\uff20": "@"} | dict.fromkeys("\u00a0\u2007\u202f", " ")
# Blocks read for decimal digits alone, and blocks read for compatibility forms (superscripts,
# letter-like signs and number forms, enclosed and full-width characters, mathematical letters).
_DIGIT_BLOCKS = [(0x0660, 0x1000), (0x17E0, 0x1820)]
_FORM_BLOCKS = [(0x00B2, 0x00BA), (0x2070, 0x209D), (0x2100, 0x218C), (0x2460, 0x24EB), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)]
_DIGITS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def _look_alikes() -> dict[int, str]:
    """Code point -> one ASCII character, from the compatibility forms and
    decimal digits of the Unicode tables and the lists above."""
    out = {}
    for digits_only, blocks in ((True, _DIGIT_BLOCKS), (False, _FORM_BLOCKS)):
        for cp in (cp for lo, hi in blocks for cp in range(lo, hi)):
            ch = chr(cp)
            digit = unicodedata.decimal(ch, None)
            form = str(digit) if digit is not None else unicodedata.normalize("NFKC", ch)
            if len(form) == 1 and "!" <= form <= "~" and (digit is not None or not digits_only):
                out[cp] = form
    for table in (_CYRILLIC, _GREEK, _SIGNS):
        out.update({ord(k): v for k, v in table.items()})
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


class Detector:
    """Compiled patterns and transducers; one per Python worker."""

    def __init__(self):
        self.host = re.compile(_HOST)
        self.ip, self.card, self.phone = re.compile(_IP), re.compile(_CARD), re.compile(_PHONE)
        self.glyphs = _look_alikes()
        self.glyph_set = frozenset(map(chr, self.glyphs))
        word = "|".join([*_DIGITS, "oh"])
        self.digit_of = {w: str(i) for i, w in enumerate(_DIGITS)} | {"oh": "0"}
        self.spelled = re.compile(rf"\b(?:plus[ -])?(?:{word})(?:[ -](?:{word}))(?:[ -](?:{word}))+\b", re.I)
        self.spelled_word = re.compile(rf"plus|{word}", re.I)
        group = rf"(?:{word})(?:[ -](?:{word})){{0,2}}"
        point = r"(?: (?:dot|point) | ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| ?\. ?)"
        self.spelled_ip = re.compile(rf"\b{group}(?:{point}{group}){{3}}\b", re.I)
        self.spelled_part = re.compile(rf"(?:{word})(?:[ -](?:{word}))*", re.I)
        self.bracket = re.compile(r" ?[\[({<] ?(at|dot|[@.]) ?[\])}>] ?", re.I)
        dot = r"(?: dot | ?[\[({<] ?(?:dot|\.) ?[\])}>] ?)"
        self.word_dot = re.compile(r"(?<=[A-Za-z0-9_%+-]) dot (?=[A-Za-z0-9_%+-])", re.I)
        self.word_at = re.compile(rf"(?<=[A-Za-z0-9._%+-]) at (?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+{dot}[A-Za-z0-9-])", re.I)
        # hints over lower-cased text: necessary conditions that scan fast
        self.hint = re.compile(r"[\[({<] ?(?:at|dot|[@.]) ?[\])}>]").search
        self.hint_digits = re.compile(rf"(?:{word})[ -](?:{word})[ -](?:{word})").search
        self.hint_ip = re.compile(rf"(?:{word}){point}(?:{word})").search

    def emails(self, text: str) -> Iterator[tuple[int, int]]:
        done, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            m = self.host.match(text, at + 1) if start < at else None
            if m:
                done = m.end()
                yield start, done
            else:
                done = max(done, at + 1)  # no later match can begin before this sign
            at = text.find("@", max(done, at + 1))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind rank, end) of the four kinds, in order."""
        out = []
        if "@" in text:
            out += [(a, 0, b) for a, b in self.emails(text)]
        for m in self.ip.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in self.card.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in self.phone.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
        out.sort()
        return out

    def edits(self, text: str) -> list[tuple[int, int, str]]:
        """Rewrites of at/dot disguises and spelled digits: (start, end, output)."""
        out, low = [], text.lower()
        if self.hint_ip(low):
            for m in self.spelled_ip.finditer(text):
                parts = [self.spelled_word.findall(p.lower()) for p in self.spelled_part.findall(m.group())]
                out.append((m.start(), m.end(), ".".join("".join(self.digit_of[w] for w in p) for p in parts)))
        if " dot " in low or self.hint(low):
            out += [(m.start(), m.end(), "@" if m.group(1).lower() in ("at", "@") else ".")
                    for m in self.bracket.finditer(text)]
            out += [(m.start(), m.end(), ".") for m in self.word_dot.finditer(text)]
            out += [(m.start(), m.end(), "@") for m in self.word_at.finditer(text)]
        if self.hint_digits(low):
            for m in self.spelled.finditer(text):
                words = self.spelled_word.findall(m.group().lower())
                out.append((m.start(), m.end(), "".join("+" if w == "plus" else self.digit_of[w] for w in words)))
        out.sort(key=lambda e: (e[0], -e[1]))
        kept, end = [], 0
        for e in out:   # the earliest, and of these the longest, goes first
            if e[0] >= end:
                kept.append(e)
                end = e[1]
        return kept

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        plain = text if text.isascii() or self.glyph_set.isdisjoint(text) else text.translate(self.glyphs)
        edits = self.edits(plain)
        if not edits and plain is text or plain == text and not edits:
            return []
        pieces, out_at, src_at, width = [], [0], [0], [1]
        pos = size = 0
        for a, b, s in edits:
            if a > pos:
                pieces.append(plain[pos:a])
                size += a - pos
            out_at.append(size), src_at.append(a), width.append(0)  # len(s) characters from [a, b)
            pieces.append(s)
            size += len(s)
            out_at.append(size), src_at.append(b), width.append(1)
            pos = b
        pieces.append(plain[pos:])
        norm = "".join(pieces)

        def source(i: int) -> tuple[int, int]:
            k = bisect.bisect_right(out_at, i) - 1
            if width[k]:
                return src_at[k] + i - out_at[k], src_at[k] + i - out_at[k] + 1
            return src_at[k], src_at[k + 1]

        taken = {k: [(a, b) for a, r, b in base if r == k] for k in range(len(KINDS))}
        extra = []
        for a, k, b in self.spans(norm):
            s, e = source(a)[0], source(b - 1)[1]
            j = bisect.bisect_left(taken[k], (s, s))
            near = taken[k][max(0, j - 1):j + 1]
            if not any(x <= s and e <= y for x, y in near):
                extra.append((s, k, e))
        return extra


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts of base spans by kind, base_sha256,
    spans (base and added), n_added."""
    schema = (f"`{id_col}` {id_type(docs, id_col)}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, n_added long")

    def scan(batches):
        d = worker_cache("pii", Detector)
        for b in batches:
            rows = []
            for t in b.column(1):
                t = t.as_py()
                base = d.spans(t)
                extra = d.added(t, base)
                n = [0] * len(KINDS)
                for _, k, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(spans_text(base).encode()).hexdigest(),
                             spans_text(sorted(base + extra)), len(extra)))
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=[id_col, "n_email", "n_ip", "n_card", "n_phone",
                                                    "base_sha256", "spans", "n_added"])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(scan, schema)


def mask(text: str, spans) -> str:
    """``text`` with every span, or union of overlapping spans, replaced by the
    bracketed kind of its first span."""
    out, pos, i = [], 0, 0
    spans = sorted(spans)
    while i < len(spans):
        a, k, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][2])
        out.append(text[pos:a] + f"[{KINDS[k].upper()}]")
        pos, i = b, i + 1
    out.append(text[pos:])
    return "".join(out)


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked; ``length_col``, if present, becomes
    the new length in characters.  A null text stays null."""
    @F.pandas_udf("string")
    def masked(texts):
        d = worker_cache("pii", Detector)

        def one(t):
            if t is None:
                return None
            base = d.spans(t)
            every = base + d.added(t, base)
            return mask(t, every) if every else t
        return texts.map(one)

    cols = docs.columns
    new = docs.withColumn("__masked", masked(F.col(text_col).cast("string")))
    final = []
    for c in cols:
        if c == text_col:
            final.append(F.col("__masked").alias(c))
        elif c == length_col:
            final.append(F.when(F.col("__masked").isNull(), F.col(c)).otherwise(
                F.length("__masked")).cast(docs.schema[c].dataType).alias(c))
        else:
            final.append(F.col(c))
    return new.select(*final)
