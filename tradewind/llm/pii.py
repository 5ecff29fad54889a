"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and identifier
cues.  From each anchor a local parser grows the span, validates it, and moves that kind's frontier, so
spans of one kind never overlap and are found leftmost first.

Kinds (offsets are code points, end exclusive):
  email, ip, card, phone    the base kinds
  account                   an identifier after a cue such as "IBAN" or "account no"; an IBAN also passes mod 97
  url                       an address with user information, `scheme://user@host`

Null, empty and anchor-free texts have no spans.  Repeated rows give repeated results.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import row_function

KINDS = ("email", "ip", "card", "phone", "account", "url")
BASE = KINDS[:4]
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

# Words that announce an account or identity number.
CUES = ("iban", "account", "acct", "a/c", "konto", "cuenta", "compte", "routing", "passport", "ssn")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"(?:[\x20]?(?:number|nummer|no|nr|num|n)\b\.?)?[\x20]?[:#]?[\x20]?((?:[A-Z]{2})?[0-9](?:[\x20-]?[A-Z0-9]){5,33})(?![A-Za-z0-9])")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=:-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:/[^\s<>\"]*)?")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for s in SCHEMES:
        found.add_word(s, ("scheme", len(s)))
        found.add_word(s.upper(), ("scheme", len(s)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


class Finder:
    """Finds the spans of one text after another."""

    def __init__(self) -> None:
        self.anchors = _anchors()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out: list[tuple[str, int, int]] = []
        done = dict.fromkeys(KINDS, 0)
        for last, (what, length) in self.anchors.iter(text):
            at = last - length + 1
            if what == "digit":
                if at >= done["ip"]:
                    self._ip(text, at, done, out)
                if at >= done["card"]:
                    self._card(text, at, done, out)
            elif what == "at":
                self._email(text, at, done, out)
            elif what == "plus":
                if at >= done["phone"]:
                    self._phone(text, at, done, out)
            elif what == "cue":
                self._account(text, at, last + 1, done, out)
            else:
                self._url(text, at, last + 1, done, out)
        out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        return out

    @staticmethod
    def _email(text: str, at: int, done: dict, out: list) -> None:
        start = at
        while start > done["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start == at:
            return
        m = _DOMAIN.match(text, at + 1)
        if m:
            out.append(("email", start, m.end()))
            done["email"] = m.end()
        else:
            done["email"] = at + 1  # no later address can reach over this sign

    @staticmethod
    def _ip(text: str, at: int, done: dict, out: list) -> None:
        m = _QUAD.match(text, at)
        if m is None:
            done["ip"] = _DIGITS.match(text, at).end()
            return
        done["ip"] = m.end()
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append(("ip", at, m.end()))

    @staticmethod
    def _card(text: str, at: int, done: dict, out: list) -> None:
        m = _CARD.match(text, at)
        if m is None:
            done["card"] = at + 1
            return
        done["card"] = m.end()
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", at, m.end()))

    @staticmethod
    def _phone(text: str, at: int, done: dict, out: list) -> None:
        m = _PHONE.match(text, at)
        if m is None:
            return
        done["phone"] = m.end()
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", at, m.end()))

    @staticmethod
    def _account(text: str, at: int, after: int, done: dict, out: list) -> None:
        if at and text[at - 1].isalnum():
            return  # inside another word
        m = _ACCOUNT.match(text, after)
        if m is None or m.start(1) < done["account"]:
            return
        value = m.group(1).replace(" ", "").replace("-", "")
        if sum(c.isdigit() for c in value) < 6:
            return
        if value[:2].isalpha() and len(value) >= 15 and not iban_ok(value):
            return
        out.append(("account", m.start(1), m.end(1)))
        done["account"] = m.end(1)

    @staticmethod
    def _url(text: str, at: int, after: int, done: dict, out: list) -> None:
        if at < done["url"]:
            return
        m = _USERINFO.match(text, after)
        if m:
            end = m.end()
            while text[end - 1] in ".,;:!?)'":
                end -= 1
            out.append(("url", at, end))
            done["url"] = end


def _make():
    finder = Finder()

    def work(texts):
        return [[{"kind": k, "start": s, "end": e} for k, s, e in finder.spans(t)] if t else [] for t in texts]

    return work


def find_spans(spark: SparkSession, text: Column) -> Column:
    """All spans of a text, ordered by start, then kind as in KINDS."""
    return row_function(spark, _make, SPANS)(text.cast("string"))


def pii(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """`docs` with an array of spans added (an existing column of that name is replaced)."""
    return docs.withColumn(spans, find_spans(docs.sparkSession, F.col(text)))


def mask(docs: DataFrame, text: str = "text", token: str = "<{}>") -> DataFrame:
    """`docs` with every span's text replaced by its kind; of overlapping spans the first, longer one counts."""

    def make():
        finder = Finder()

        def work(texts):
            out = []
            for t in texts:
                if not t:
                    out.append(t)
                    continue
                parts, last = [], 0
                for k, s, e in sorted(finder.spans(t), key=lambda x: (x[1], -x[2])):
                    if s >= last:
                        parts += [t[last:s], token.format(k)]
                    elif e > last:  # overlaps what is masked already
                        pass
                    last = max(last, e)
                out.append("".join(parts) + t[last:])
            return out

        return work

    return docs.withColumn(text, row_function(docs.sparkSession, make, "string")(F.col(text).cast("string")))


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """`kind:start:end` of the spans of these kinds, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
