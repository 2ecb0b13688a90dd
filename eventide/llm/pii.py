"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
address schemes and identifier cues. From each anchor a deterministic local
parser expands to both sides and checks what it found:

* at-sign -> e-mail address: the run of local-part characters to the left, labels
  joined by dots to the right (the base e-mail spans);
* scheme (``http://``, ``https://``, ``ftp://``, ``mailto:``, ...) -> ``address``: a web
  address, only where it names a person: with user information before an
  at-sign, ``mailto:`` with a mailbox that the base rule does not cover whole, or a path
  through somebody's home (``/~name``, ``/users/name``, ``/@name``, ...);
* cue ("account", "iban", "ssn", ...) -> ``account``: the identifier behind it.
  An IBAN must pass its check digits, an SSN its group rules, other
  accounts need 6 to 20 letters and digits, most of them digits.
* secret cue ("token", "api key", "password", ...) -> ``secret``: the run of key
  characters behind it. It must hold letters and digits, be 16 characters or longer
  and of high entropy (20 without a sign like ``=`` between); a password behind a sign needs 8.

The base kinds ip, card and phone start at a digit or a plus sign and are read
by linear patterns, then checked. The base spans are never changed by the added
kinds. ``n_email`` ... ``n_phone`` count the base spans; added spans have the
kinds ``address``, ``account`` and ``secret``, stand behind the base kinds in ``spans``
and are counted in columns of their own. No parser stops at a fixed distance or length.

Rules: null and empty texts have no spans; offsets are code points, end
exclusive; a text without anchors, digits or plus signs is not parsed further;
equal rows get equal answers; ties do not arise (spans of one kind do not overlap); very
long texts are searched whole; a column of the input named like the result is replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import table
from eventide.session import ship_package

KINDS = ("email", "ip", "card", "phone", "address", "account", "secret")

# Schemes and identifier cues, lower case.
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "mailto:")
CUES = ("account", "acct", "iban", "ssn", "social security", "passport", "routing", "customer id",
        "member id", "patient id", "tax id", "konto", "compte", "cuenta")
PASSWORDS = ("password", "passwd", "passphrase", "pwd")
SECRETS = ("token", "secret", "api key", "api_key", "apikey", "api-key", "access key", "access_key", "private key",
           "private_key", "auth key", "credential", "bearer", *PASSWORDS)
HOMES = ("user", "users", "u", "people", "profile", "profiles", "in", "home", "member", "members")

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# digits of a run are taken whole, so a later start in the same run finds nothing new
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CUE_GAP = re.compile(r"(?:\s*+(?:no\.?|nr\.?|number|nummer|num\.?|code|#|is|:|=|-))*+\s*+", re.I)
_SIGN = re.compile(r"""["']?+\s*+(:=|=>|=|:)?+\s*+(?:bearer\s++)?+["']?+""", re.I)
_KEY = re.compile(r"[A-Za-z0-9+/_.~-]++")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"[A-Za-z]{0,3}[0-9](?:[ -]?[0-9A-Za-z]){5,19}(?![0-9A-Za-z])")
_USER = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=:-]++")
_HOST = re.compile(r"@[A-Za-z0-9.-]++(?::[0-9]++)?+")
_PLACE = re.compile(r"[A-Za-z0-9.-]++(?::[0-9]++)?+(?:/[A-Za-z0-9._~%@-]*+)++")
_SEGMENT = re.compile(r"/([A-Za-z0-9._~%@-]*+)")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not before ``floor``."""
    m = _DOMAIN.match(text, at + 1)
    if not m:
        return None
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return (start, m.end()) if start < at else None


def _part_ok(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 3 or (len(p) == 3 and p <= "255")


def account_after(text: str, at: int, cue: str = "") -> tuple[int, int] | None:
    """The identifier that a cue ending at ``at`` announces."""
    gap = _CUE_GAP.match(text, at)
    at = gap.end() if gap else at
    # "no" may be the country of a number rather than the word
    for start in ((at - 2, at) if text[at - 2:at].lower() == "no" else (at,)):
        m = _IBAN.match(text, start)
        while m:  # greedy groups may run into the next word
            end = m.end()
            if iban_ok(m[0]):
                return m.start(), end
            cut = text.rfind(" ", start, end)
            if cut < 0:
                break
            m = _IBAN.match(text, start, cut)
    if cue == "iban":
        return None
    m = _SSN.match(text, at)
    if m:
        return m.span()
    m = _ACCOUNT.match(text, at)
    if m:
        digits = sum(c.isdigit() for c in m[0])
        letters = sum(c.isalpha() for c in m[0])
        if digits >= 6 and digits > 2 * letters:
            return m.span()
    return None


def entropy(s: str) -> float:
    """Bits per character of the characters' own frequencies."""
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def secret_after(text: str, at: int, cue: str) -> tuple[int, int] | None:
    """The key that a secret cue ending at ``at`` announces."""
    sign = _SIGN.match(text, at)
    m = _KEY.match(text, sign.end())
    if not m or m.start() == at:  # the cue goes on as a word
        return None
    key = m[0].rstrip(".")
    least = (8 if cue in PASSWORDS else 16) if sign[1] else 20
    if len(key) < least or not any(c.isdigit() for c in key) or not any(c.isalpha() for c in key):
        return None
    return (m.start(), m.start() + len(key)) if entropy(key) >= (2.5 if len(key) < 16 else 3.0) else None


def home_at(text: str, at: int) -> int | None:
    """End of the path segment that names a person, of the web address whose host
    starts at ``at``."""
    m = _PLACE.match(text, at)
    if m:
        before = ""
        for part in _SEGMENT.finditer(m[0]):
            name = part[1]
            if (len(name) > 1 and name[0] in "~@") or (name and before in HOMES):
                return at + part.end()
            before = name.lower()
    return None


_AUTOMATON = None


def automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick
        _AUTOMATON = ahocorasick.Automaton()
        _AUTOMATON.add_word("@", ("at", 1))
        for s in SCHEMES:
            _AUTOMATON.add_word(s, ("scheme", len(s)))
        for s in CUES:
            _AUTOMATON.add_word(s, ("cue", len(s)))
        for s in SECRETS:
            _AUTOMATON.add_word(s, ("secret", len(s)))
        _AUTOMATON.make_automaton()
    return _AUTOMATON


_FOLD = {c: c + 32 for c in range(65, 91)}
_ASCII_UPPER = re.compile("[A-Z]")


def find_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """All spans of a text by kind, each kind in text order."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    folded = text.lower() if text.isascii() else text.translate(_FOLD)  # same offsets
    floor = last = dead = 0
    for end, (what, n) in automaton().iter(folded):
        end += 1
        if what == "at":
            m = email_at(text, end - 1, floor) if end - 1 >= floor else None
            if m:
                out["email"].append(m)
                floor = m[1]
        elif end - n < last or (end - n > 0 and text[end - n - 1].isalnum()):
            continue
        elif what == "scheme":
            user = _USER.match(text, end) if end >= dead else None
            m = _HOST.match(text, user.end()) if user else None
            if user and not m:
                dead = user.end()  # a later scheme in the same run ends there too
            stop = m.end() if m else home_at(text, end)
            if stop:
                while text[stop - 1] in ".:,;":
                    stop -= 1
                out["address"].append((end - n, stop))
                last = stop
        elif what == "secret":
            m = secret_after(text, end, folded[end - n:end])
            if m:
                out["secret"].append(m)
                last = m[1]
        elif what == "cue" and not text[end:end + 1].isalpha():
            m = account_after(text, end, folded[end - n:end])
            if m:
                out["account"].append(m)
                last = m[1]
    # an at-sign inside an e-mail's own span cannot start another: labels have none
    if any(c in text for c in "0123456789"):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_part_ok, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out["phone"].append(m.span())
    return out


def _joined(spans: dict, kinds) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


PII = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
       "n_address long, n_account long, n_secret long")


def personal_data(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``name``: counts, digest, spans."""
    ship_package(docs.sparkSession)
    fields = [f.split()[0] for f in PII.split(", ")]

    @F.pandas_udf(PII)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = find_spans(t)
                base = _joined(s, KINDS[:4])
                rows.append((*(len(s[k]) for k in KINDS[:4]), hashlib.sha256(base.encode()).hexdigest(),
                             _joined(s, KINDS), *(len(s[k]) for k in KINDS[4:])))
            yield pd.DataFrame(rows, columns=fields)

    return docs.withColumn(name, scan(F.col(text_col)))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def hide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else _hidden(t) for t in texts], dtype=object)

    return docs.withColumn(text_col, hide(F.col(text_col)))


def _hidden(text: str) -> str:
    found = sorted((a, -b, k) for k, s in find_spans(text).items() for a, b in s)
    parts, at = [], 0
    for a, b, k in found:
        if a >= at:
            parts += [text[at:a], f"[{k}]"]
            at = -b
        elif -b > at:  # overlapping spans: the rest goes too
            at = -b
    return "".join([*parts, text[at:]])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data(docs).select("doc_id", "pii.*")
