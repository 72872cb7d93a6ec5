"""Secret scans: keyword prefilter, anchored patterns near hits, embedded checksums.

One pass of an Aho-Corasick automaton over the folded text finds every keyword. An anchored
pattern is then tried at the hits of its own keywords only. Patterns whose format embeds a
checksum are reported only if the checksum holds.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]

SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_checksum(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits, the checksum at the end of several tokens."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = _BASE62[d] + digits
    return digits


def _checked(match: re.Match) -> bool:
    return base62_checksum(match[1]) == match[2]


# kind: folded keywords, anchored pattern, what a match must pass
_RULES = {
    "assign": (
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        _ASSIGN,
        lambda m: len(m[1]) >= 6,
    ),
    "access": (("akia",), _ACCESS, lambda m: m.end() - m.start() >= 20),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _GITHUB, _checked),
    "npm": (("npm_",), _NPM, _checked),
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, (keywords, _, _) in _RULES.items():
        for word in keywords:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _folded(text: str) -> str:
    """Lower case without a change of length, so that places stay the same."""
    folded = text.lower()
    return folded if len(folded) == len(text) else "".join(
        x if len(x := c.lower()) == 1 else c for c in text
    )


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points, by start and then by kind.

    Spans of one kind are leftmost and do not overlap; a match that fails its test still
    uses up its characters, as a scan with the pattern alone would.
    """
    if not text:
        return []
    spans = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    hits = sorted(
        (end - n + 1, kind) for end, (kind, n) in _automaton().iter(_folded(text))
    )
    upto = dict.fromkeys(_RULES, 0)
    for start, kind in hits:
        _, pattern, passes = _RULES[kind]
        if start >= upto[kind] and (m := pattern.match(text, start)):
            upto[kind] = m.end()
            if passes(m):
                spans.append((kind, start, m.end()))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def masked(text: str | None, mark: str) -> str | None:
    """``text`` with every run of overlapping secrets replaced by ``mark``."""
    parts, upto, stop = [], 0, -1
    for _, a, b in find_secrets(text):
        if a >= stop:  # not inside the run before
            parts += [text[upto:a], mark]
        stop = upto = max(stop, b)
    return "".join(parts) + text[upto:] if parts else text


def secret_spans(text: Column) -> Column:
    """The secrets of a text as an array of (kind, start, stop), places in code points.

    Null and empty texts have none. Every row is scanned on its own and as a whole.
    """

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array(
            [
                [{"kind": k, "start": a, "stop": b} for k, a, b in find_secrets(t)]
                for t in texts.to_pylist()
            ],
            _SPANS,
        )

    return scan(text)


def mask_secrets(text: Column, mark: str = "[SECRET]") -> Column:
    """The text with its secrets masked; null stays null, a clean text stays as it is."""

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t, mark) for t in texts.to_pylist()], pa.string())

    return mask(text)


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans of the given kinds as ``kind:start:stop``, joined by commas."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
