"""URL filters: all glob rules at once, as one bit-parallel wildcard automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_fields

ALLOW, BLOCK = "allow", "block"
# Globs over the canonical URL, for urls that no host rule fits; the first that fits decides.
KEYWORDS = [("*casino*", BLOCK), ("*porn*", BLOCK), ("*xxx*", BLOCK), ("*viagra*", BLOCK)]

FIELDS = ["host", "path", "rule", "verdict"]
# Symbols beyond the 256 bytes: between host and path, and after the path.
_BORDER, _END, _SYMBOLS = 256, 257, 258


def _ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (after the first `://`, A-Z lower-cased) and path (from there up to `?`, `#` or the end)."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    stop = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find("/")
    return (_ascii_lower(rest), "") if slash < 0 else (_ascii_lower(rest[:slash]), rest[slash:])


def host_glob(rule: str) -> list[int | str]:
    """A rule `host/path` as symbols: any subdomain of the host, then a path that begins with the rule's."""
    host, _, path = rule.partition("/")
    return ["*", *f".{host}".encode(), _BORDER, *f"/{path}".encode(), "*", _END]


def text_glob(glob: str) -> list[int | str]:
    """A glob over the canonical URL: `*` is any run, also across the border of host and path, `?` any one byte."""
    return [*(chr(b) if b in b"*?" else b for b in glob.encode()), _END]


@dataclass
class Automaton:
    """Shift-And masks of several globs, side by side in as many 64-bit words as they need.

    A bit is one symbol of one glob. `symbol` says which bits a symbol may set, `first` where
    globs begin, `free` the beginnings that may come at any place, `loop` the bits that a `*`
    after them keeps, `last` where globs end; `owner` numbers the glob of each bit.
    """

    symbol: np.ndarray
    first: np.ndarray
    free: np.ndarray
    loop: np.ndarray
    last: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, globs: list[list[int | str]]) -> Automaton:
        size = sum(1 for g in globs for s in g if s != "*")
        words = max(1, -(-size // 64))
        masks = [np.zeros(words, np.uint64) for _ in range(4)]
        first, free, loop, last = masks
        symbol = np.zeros((_SYMBOLS, words), np.uint64)
        owner = np.full(words * 64, -1)
        bit = 0

        def put(mask: np.ndarray, at: int) -> None:
            mask[at // 64] |= np.uint64(1) << np.uint64(at % 64)

        for number, glob in enumerate(globs):
            begin = bit
            for i, s in enumerate(glob):
                if s == "*":
                    put(free if bit == begin else loop, bit if bit == begin else bit - 1)
                    continue
                for b in range(256) if s == "?" else [s]:
                    put(symbol[b], bit)
                owner[bit] = number
                bit += 1
            put(first, begin)
            put(last, bit - 1)
        return cls(symbol, first, free, loop, last, owner)

    def fits(self, texts: list[list[int]]) -> np.ndarray:
        """For each text the number of the first glob that fits it whole, -1 where none does.

        All texts move on together, one symbol at a time; the longest come first, so that
        those still running are always the head of the array.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([np.asarray(t, np.int64) for t in texts]) if len(texts) else np.zeros(0, np.int64)
        begins = (np.cumsum(sizes) - sizes)[order]
        lengths = sizes[order]
        state = np.zeros((len(texts), len(self.first)), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(lengths[0]) if len(lengths) else 0):
            running = int(np.searchsorted(-lengths, -t, side="left"))
            now = state[:running]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved = (moved & ~self.first) | (self.first if t == 0 else self.free)
            state[:running] = (moved & self.symbol[flat[begins[:running] + t]]) | (now & self.loop)
        ended = state & self.last
        out = np.full(len(texts), -1)
        for w in range(ended.shape[1]):
            hit = np.flatnonzero((out < 0) & (ended[:, w] != 0))
            lowest = ended[hit, w] & (~ended[hit, w] + one)
            out[hit] = self.owner[w * 64 + np.log2(lowest.astype(np.float64)).astype(np.int64)]
        back = np.empty(len(texts), np.int64)
        back[order] = out
        return back


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    url_col: str = "url",
    keywords: list[tuple[str, str]] = KEYWORDS,
    otherwise: str = ALLOW,
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`; input columns of these names are replaced.

    `rules` are (`host/path`, verdict): a rule fits its host and all subdomains where the path begins
    with the rule's; the longest wins, of equal ones the first by text. Where none fits, `rule` is
    null and the verdict is that of the first of `keywords` (globs over `.host` and path, case kept in
    the path) that fits, else `otherwise`. A null url, or one without `://`, has an empty host and
    path, which no rule fits, and is blocked as not a web address; so is one whose host is empty.

    The automaton grows with the rules, not the pages: one bit for each symbol of a rule.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r[0]), r))
    globs = [host_glob(r) for r, _ in ranked] + [text_glob(g) for g, _ in keywords]
    verdicts = [v for _, v in ranked] + [v for _, v in keywords]

    @F.arrow_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = Automaton.of(globs)
        for urls in batches:
            parts = [split_url(u) for u in urls.to_pylist()]
            texts = [[*f".{h}".encode("utf-8", "surrogatepass"), _BORDER, *p.encode("utf-8", "surrogatepass"), _END] for h, p in parts]
            fit = automaton.fits(texts).tolist()
            rule = [ranked[k][0] if 0 <= k < len(ranked) else None for k in fit]
            verdict = [BLOCK if not h else verdicts[k] if k >= 0 else otherwise for k, (h, _) in zip(fit, parts, strict=True)]
            hosts, paths = [h for h, _ in parts], [p for _, p in parts]
            yield pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (hosts, paths, rule, verdict)], FIELDS)

    return with_fields(pages, judge(F.col(url_col)), FIELDS)
