"""Quality rules, line first: drop failing lines, then documents that lose too much.

Words are runs of characters other than the six ASCII white-space characters.
A document is judged in two steps. The base rules ask for enough words and for
few words in repeated three-word windows. Then every line is judged on its own:

* punctuation: most of its words carry marks that prose does not (symbols of
  ``SYMBOLS`` or doubled exclamation or question marks), or it is a short line
  without any closing mark;
* navigation: menu separators stand between its entries (three entries are enough
  where each has one to four words and no closing mark ends the line);
* boilerplate: stock phrases of web pages make up half of its word characters or more.

Failing lines are removed, and a document that loses more than ``max_lost`` of
its word characters is rejected.

Defined cases: a null or blank text has no words and fails the base rules;
lines are parts between ``\\n``, and only lines with a word count; repeated rows
are judged alike, each on its own; result columns replace input columns of the
same name, all other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import release_memory, text_runs

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\r\x0b\f"
_MARKS = tuple(c.encode() for c in SYMBOLS)

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST = 0.5

#: Closing marks of a line of prose, also before closing quotes or brackets.
_CLOSED = re.compile(r"[.!?…。！？:;,][\"'”’»)\]]*\s*$")
_SHOUT = re.compile(r"[!?]{2,}")
_SEPARATORS = "|»›•·>"
_MENU = re.compile(rf"(?:^|\s)[{_SEPARATORS}](?=\s|$)")
#: Stock phrases of web pages, in lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "uses cookies", "enable javascript", "click here", "read more", "sign up", "log in", "sign in", "subscribe to",
    "share this", "skip to content", "back to top", "powered by", "lorem ipsum",
)
_STOCK = re.compile("|".join(map(re.escape, BOILERPLATE)), re.I | re.A)
#: A line without a closing mark is no prose below this many words.
FRAGMENT_WORDS = 4

RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_lines long, n_failed_lines long, lost double, kept boolean"
_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_failed_lines", "lost", "kept", "cleaned")


def failed_rule(line: str) -> str | None:
    """The rule that a line with at least one word fails, or None."""
    words = line.encode("utf-8", "surrogatepass").split()
    n = len(words) or 1
    symbols = sum(map(line.count, SYMBOLS))
    if symbols >= 3:
        menu = len(_MENU.findall(line))
        if 4 * menu >= n - menu:  # an entry has four words at most
            return "navigation"
        if 2 * symbols >= n and 2 * sum(1 for w in words if any(c in w for c in _MARKS)) > n:
            return "punctuation"
    elif "»" in line or "›" in line or "•" in line or "·" in line:
        menu = len(_MENU.findall(line))
        if menu >= 3 and 4 * menu >= n - menu:
            return "navigation"
    if any(c in line for c in _SEPARATORS) and not _CLOSED.search(line):
        entries = _MENU.split(line)
        if len(entries) == 3 and all(1 <= len(e.encode("utf-8", "surrogatepass").split()) <= 4 for e in entries):
            return "navigation"
    if ("!!" in line or "??" in line) and 2 * len(_SHOUT.findall(line)) > n:
        return "punctuation"
    low = line.lower()
    if any(p in low for p in BOILERPLATE):
        stock = sum(len(m) - m.count(" ") for m in _STOCK.findall(line))
        if 2 * stock >= len(line) - sum(map(line.count, _SPACE)):
            return "boilerplate"
    if n < FRAGMENT_WORDS and not _CLOSED.search(line):
        return "punctuation"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, first occurrences too."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    v = len(numbers)
    if v == n:
        return 0
    if v < 2_000_000:
        windows = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # three numbers no longer fit in 63 bits
        pairs = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)[1]
        windows = pairs * v + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum())


def judge(text: str | None, max_lost: float = MAX_LOST) -> tuple:
    """All result fields of one text, and the text without its failing lines."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, _SPACE))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    n_dup = n_lines = n_failed = lost_chars = 0
    good = []
    for line in text.split("\n"):
        if not line.strip(_SPACE):
            good.append(line)
            continue
        n_lines += 1
        if line in seen:
            n_dup += 1
        seen.add(line)
        if failed_rule(line):
            n_failed += 1
            lost_chars += len(line) - sum(map(line.count, _SPACE))
        else:
            good.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    lost = lost_chars / word_chars if word_chars else 0.0
    kept = not base_failed and lost <= max_lost
    return len(words), word_chars, n_symbols, n_dup, repeated, base_failed, n_lines, n_failed, lost, kept, "\n".join(good) if n_failed else text


def judge_documents(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST, cleaned: bool = False) -> DataFrame:
    """The documents with the fields of ``RESULT``, and ``cleaned`` text on request.

    One narrow pass: no shuffle, and each Arrow batch is judged on its own.
    """
    kind = f"struct<{RESULT.replace(' long', ':bigint').replace(' boolean', ':boolean').replace(' double', ':double')}{', cleaned:string' if cleaned else ''}>"
    fields = _FIELDS if cleaned else _FIELDS[:-1]

    @F.arrow_udf(kind)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = [(f, dict(base_failed=pa.bool_(), kept=pa.bool_(), lost=pa.float64(), cleaned=pa.string()).get(f, pa.int64())) for f in fields]
        for texts in batches:
            parts = [pa.array([], pa.struct(kinds))]
            for some in text_runs(texts):
                columns = zip(*[judge(t.as_py(), max_lost) for t in some])
                parts.append(pa.StructArray.from_arrays([pa.array(c, k) for (_, k), c in zip(kinds, columns)], names=list(fields)))
            yield pa.concat_arrays(parts)
        release_memory()

    mark = "__judged"
    return docs.withColumn(mark, judged(text_col)).withColumns({f: F.col(f"{mark}.{f}") for f in fields}).drop(mark)
