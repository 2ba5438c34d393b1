"""Secret scans by dictionary-primed zstandard novelty.

Beside three plain patterns (assignments, access keys, long hex runs), candidate strings in a sensitive
context are measured: a compressor primed with a dictionary of identifiers compresses the text around the
candidate with and without it.  The difference is what the candidate adds that neither the code around it
nor the dictionary explains.  Words and identifiers cost little; a random key costs near its entropy, and
is reported when it costs ``min_gain`` bytes a character or more.

Scale: every text is scanned whole in its own task, one row at a time; nothing is shuffled.  The dictionary
is a parameter of a few kilobytes.  Only strings near a sensitive word are compressed.

The context is the word's line, the lines around it and the blocks of encoded lines that begin or end there, before and
after the word; of a long line, 256 characters on each side.  Every string of 16 characters or more that starts or ends
in a context is measured as a whole; names at its ends that hold a sensitive word are cut off.

Spans are code points, end exclusive.  Base patterns match leftmost, without overlaps in a kind; a match that
is too short is dropped.  A measured string inside a base span adds nothing and isn't repeated.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows get equal spans; input
columns named like an output column are replaced.
"""
from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_rows, col, others, plain_names

# fixed patterns of the base kinds, in the order in which spans with one start are listed
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "novel")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")               # finds the same runs: a run is matched from its start

SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private_key",
             "credential", "auth", "bearer", "signature", "client_id", "connectionstring", "akia")
_SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_CANDIDATE_CHAR = re.compile(r"[A-Za-z0-9+/_=-]")
_BLOCK = re.compile(r"""[\x20\t>"'+]*[A-Za-z0-9+/_=-]{16,}[\x20\t"'+,;\\\r]*""")       # a line of a block of encoded bytes
_MARK = re.compile(r"""[\x20\t>"'+]*-----BEGIN[^\n]*""")

# identifiers that code around keys is made of; the longest and likeliest last, nearest to the text
IDENTIFIERS = (
    "abstract assert async await boolean break case catch class const continue default define delete double else "
    "except export extends false final finally float foreach from function global implements import include "
    "instance interface lambda module namespace nullptr object operator override package private protected public "
    "raise require return static string struct super switch template this throw true typedef typename undefined "
    "unsigned using virtual void volatile while yield begin end local self print printf println format length size "
    "index value values count total result response request session context config configuration settings options "
    "parameters arguments environment variable variables username user_name user_id email address hostname port "
    "database connection connect timeout retries endpoint service server client region bucket storage account "
    "project application version development production staging example localhost https http www com org net "
    "header headers content_type application_json authorization bearer basic digest cookie cookies certificate "
    "public_key private_key access_key access_key_id secret_access_key client_id client_secret api_key api_token "
    "auth_token refresh_token id_token token_type expires_in password_hash encryption_key signing_key "
    "connection_string credentials credential secret password passwd token ")

SPANS = "array<struct<kind:string,start:int,end:int,gain:int>>"
OUT = ("n_assign", "n_access", "n_hex", "found")
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("gain", pa.int32())]))


class Novelty:
    """Bytes that a string adds to its surroundings under a primed compressor."""

    def __init__(self, dictionary: str = IDENTIFIERS, before: int = 256, after: int = 128, level: int = 6):
        raw = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=level)
        self.z = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False, write_dict_id=False)
        self.before, self.after = before, after

    def gain(self, text: str, start: int, end: int) -> int:
        left, right = text[max(0, start - self.before):start], text[end:end + self.after]
        size = lambda s: len(self.z.compress(s.encode("utf-8", "surrogatepass")))
        return size(left + text[start:end] + right) - size(left + right)


def base_spans(text: str, sensitive: bool = True) -> list[tuple[str, int, int]]:
    found = []
    if sensitive:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return found


def contexts(text: str, words: list[tuple[int, int]], reach: int, wide: int) -> list[tuple[int, int]]:
    """Ranges around the sensitive words, merged: ``reach`` characters, the word's line with the lines before and after
    it (``wide`` characters of them), and the blocks that end or begin there."""
    starts = [0, *(m.end() for m in re.finditer("\n", text))]
    ends = [*(s - 1 for s in starts[1:]), len(text)]
    block = [_BLOCK.fullmatch(text, s, e) is not None for s, e in zip(starts, ends)]
    mark = [not x and _MARK.fullmatch(text, s, e) is not None for x, s, e in zip(block, starts, ends)]
    n, top, bottom = len(starts), list(range(len(starts))), list(range(len(starts)))    # first and last line of a line's block
    for i in range(1, n):
        if block[i] and block[i - 1]:
            top[i] = top[i - 1]
    for i in range(n - 2, -1, -1):
        if block[i] and block[i + 1]:
            bottom[i] = bottom[i + 1]
    out: list[tuple[int, int]] = []
    for s, e in words:
        i = bisect_right(starts, s) - 1
        a, b = min(s - reach, max(starts[i], s - wide)), max(e + reach, min(ends[i], e + wide))
        if i > 0 and s - starts[i] <= wide:
            a = min(a, max(starts[i - 1], starts[i] - wide))
            k = i - 1 - (mark[i - 1] and i > 1)
            a = min(a, starts[top[k]]) if block[k] else a
        if i < n - 1 and ends[i] - e <= wide:
            b = max(b, min(ends[i + 1], ends[i] + wide))
            k = i + 1 + (mark[i + 1] and i < n - 2)
            b = max(b, ends[bottom[k]]) if block[k] else b
        a, b = max(0, a), min(len(text), b)
        while out and a <= out[-1][1]:
            x, y = out.pop()
            a, b = min(a, x), max(b, y)
        out.append((a, b))
    return out


def trimmed(text: str, s: int, e: int, words: list[tuple[int, int]], novelty: Novelty, min_gain: float) -> tuple[int, int]:
    """The string without the names at its ends: a sensitive word there goes, and with it what lies further out
    if that is a short part of a name or adds less than ``min_gain`` a character."""
    def name(x: int, y: int, near: str) -> bool:
        return x == y or (near in "_=-" if y - x < 16 else novelty.gain(text, x, y) < min_gain * (y - x))
    a, b = s, e
    for x, y in words:
        if not name(a, x, text[x - 1:x]):
            break
        a = y
    for x, y in reversed(words):
        if x < a or not name(y, b, text[y:y + 1]):
            break
        b = x
    return a, b


def scan_text(text: str, novelty: Novelty, min_gain: float = 0.6, reach: int = 48, wide: int = 256) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, bytes added) of all spans, by start and then by kind."""
    low = text.lower()
    near = any(w in low for w in SENSITIVE)            # a cheap test; most texts have no such word
    base = base_spans(text, near)
    out = [(k, s, e, 0) for k, s, e in base]
    if near:
        words = [m.span() for m in _SENSITIVE.finditer(text)]
        starts = [s for s, _ in words]
        opens = sorted((s, e) for _, s, e in base)     # base spans by start, with the furthest end so far
        ends = list(accumulate((e for _, e in opens), max))
        seen = 0
        for a, b in contexts(text, words, reach, wide):
            while a > seen and _CANDIDATE_CHAR.match(text, a - 1):                # a string that ends in the context
                a -= 1
            for c in _CANDIDATE.finditer(text, max(a, seen)):
                s, e = c.span()
                if s >= b:
                    break
                seen = e
                inside = words[bisect_left(starts, s):bisect_left(starts, e)]
                inside = [w for w in inside if w[1] <= e]
                whole = trimmed(text, s, e, inside, novelty, min_gain)
                cuts = [s, *(x for w in inside for x in w), e]
                for pieces in ([whole], list(zip(cuts[::2], cuts[1::2]))):        # else what lies between the words
                    hits = []
                    for x, y in pieces:
                        k = bisect_right(opens, (x, len(text))) - 1
                        if y - x >= 16 and not (k >= 0 and y <= ends[k]) and (g := novelty.gain(text, x, y)) >= min_gain * (y - x):
                            hits.append(("novel", x, y, g))
                    if hits or len(cuts) == 2:
                        break
                out += hits
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


@plain_names
def scan(docs: DataFrame, dictionary: str = IDENTIFIERS, min_gain: float = 0.6, reach: int = 48,
         carry: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns in ``carry``, by default all) with the number of base spans of each kind and
    ``found``, all spans with the bytes that a measured string adds."""
    keep = others(docs.select(*[col(c) for c in carry]) if carry is not None else docs, OUT)
    has = any(c.lower() == "text" for c in keep)       # a text that is kept anyway isn't sent twice
    df = docs.select(*[col(c) for c in keep], *([] if has else [col("text")]))
    text_at = next(i for i, c in enumerate(df.columns) if c.lower() == "text")
    schema = docs.select(*[col(c) for c in keep]).schema
    for f in T._parse_datatype_string(f"n_assign long, n_access long, n_hex long, found {SPANS}").fields:
        schema = schema.add(f)

    def run(batches):
        novelty = Novelty(dictionary)
        for b in batches:
            found = [scan_text(t.as_py() or "", novelty, min_gain, reach) for t in b.column(text_at)]
            counts = [pa.array([sum(x[0] == k for x in f) for f in found], pa.int64()) for k in KINDS[:3]]
            spans = pa.array([[dict(zip(("kind", "start", "end", "gain"), x)) for x in f] for f in found], _SPAN)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *counts, spans], names=[f.name for f in schema.fields])

    return arrow_rows(df).mapInArrow(run, schema)
