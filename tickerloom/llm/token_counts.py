"""Token counts by rank-synchronous merging of byte pairs in ragged numpy arrays.

Works for vocabularies with byte-level symbols and word ends that lower-case texts.

1. A text is cut at the added special strings, which count as one token each, as the library does by default.
   What is between them is split into pre-tokens by the vocabulary's own pattern; parts with letters beyond
   Latin Extended-A or with control characters go through the library's normaliser and pre-tokeniser.
2. The new distinct pre-tokens of some texts are laid out as one array of symbols with bounds. In every round
   each pre-token looks up its lowest-rank pair and merges all its places at once, left to right; pre-tokens
   without a mergeable pair leave with the symbols they have. Rounds end when none is left.
3. Counts go back to the texts that hold the pre-tokens.

Merging all places of a pair at once equals merging them one by one from the left unless the new symbol
starts a pair of a lower rank; for those ranks (known from the vocabulary) only the leftmost place is merged.

One pass without a shuffle; a task holds 1,000 texts and a table of known pre-tokens that is emptied at
`KNOWN_PIECES` entries (this bounds memory, results do not depend on it).

Defined results: null and empty texts have no tokens; repeated rows give repeated results; ids may be null
or repeated; columns outside `keep` are not read; an empty table gives none.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerloom.llm.common import CHUNK_BYTES, small_batches, text_or_empty

KNOWN_PIECES = 200_000
NONE = np.int64(1 << 40)  # rank of a pair that does not merge
# Letters up to Latin Extended-A and white space: composed as they are, lowered alike everywhere.
PLAIN = re.compile("[\t-\r -~\x80-\u017f]*")


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: itself if it is visible in Latin-1, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merger:
    """The merges of a vocabulary as sorted arrays, and counts of surviving symbols."""

    def __init__(self, ids: dict[str, int], merges: list, suffix: str):
        chars = byte_symbols().values()
        self.inner = np.full(512, -1, np.int64)
        self.last = np.full(512, -1, np.int64)
        for c in chars:
            self.inner[ord(c)] = ids.get(c, -1)
            self.last[ord(c)] = ids.get(c + suffix, -1)
        if min(self.inner[[ord(c) for c in chars]].min(), self.last[[ord(c) for c in chars]].min()) < 0:
            raise ValueError("the vocabulary lacks symbols of single bytes")
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in merges]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        # Merged symbols carry the suffix of their right part only.
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        first = np.full(max(ids.values()) + 1, NONE)
        ranks = np.arange(len(keys))
        np.minimum.at(first, left, ranks)
        np.minimum.at(first, right, ranks)
        self.one_by_one = first[self.made] < ranks

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token (non-empty strings of byte symbols)."""
        out = np.zeros(len(pieces), np.int64)
        if not pieces:
            return out
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        size = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(size)
        symbols = self.inner[points]
        symbols[ends - 1] = self.last[points[ends - 1]]
        which = np.arange(len(pieces))
        rank = np.full(len(symbols), NONE)
        rank[:-1] = self.rank_of(symbols[:-1], symbols[1:])
        rank[ends - 1] = NONE
        while len(which):
            starts = np.cumsum(size) - size
            lowest = np.minimum.reduceat(rank, starts)
            ready = lowest == NONE
            if ready.any():
                out[which[ready]] = size[ready]
                stay = np.repeat(~ready, size)
                symbols, rank, which, size, lowest = symbols[stay], rank[stay], which[~ready], size[~ready], lowest[~ready]
                if not len(which):
                    break
            owner = np.repeat(np.arange(len(which)), size)
            hit = np.flatnonzero(rank == lowest[owner])
            # Neighbouring places of one pair overlap: of a run every second one counts, from the left.
            fresh = np.ones(len(hit), bool)
            fresh[1:] = hit[1:] != hit[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            leftmost = np.ones(len(hit), bool)
            leftmost[1:] = owner[hit[1:]] != owner[hit[:-1]]
            alone = self.one_by_one[lowest[owner[hit]]]
            hit = hit[np.where(alone, leftmost, (np.arange(len(hit)) - run) % 2 == 0)]
            symbols[hit] = self.made[lowest[owner[hit]]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            size = size - np.bincount(owner[hit], minlength=len(size))
            moved = np.cumsum(stay) - 1
            # The pair that began at the swallowed symbol is gone; pairs at the new symbol are looked up.
            symbols, rank = symbols[stay], rank[stay]
            at = moved[hit]
            close = np.cumsum(size) - 1
            final = np.zeros(len(symbols), bool)
            final[close] = True
            look = np.zeros(len(symbols) + 1, bool)
            look[at] = look[at - 1] = True
            look = np.flatnonzero(look[:-1])
            inside = look[~final[look]]
            rank[look[final[look]]] = NONE
            rank[inside] = self.rank_of(symbols[inside], symbols[inside + 1])
        return out


def plain_pattern(pattern: str) -> re.Pattern:
    """The vocabulary's pattern with its character classes spelled out for the characters of PLAIN."""
    of = lambda kind: "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c)).startswith(kind))
    return re.compile(pattern.replace(r"\p{L}", of("L")).replace(r"\p{N}", of("N")).replace(r"\s", "\t-\r \x85\xa0"))


class WordCounter:
    """Splits texts into pre-tokens as the vocabulary file says, and counts their tokens."""

    def __init__(self, path: str, known_pieces: int = KNOWN_PIECES):
        self.known_pieces = known_pieces
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a byte-level BPE vocabulary with word ends is needed")
        self.merger = Merger(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.library = Tokenizer.from_file(path)
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(re.escape(a) for a in added) + ")") if added else None
        self.opening = added[0][:2] if added else None
        if any(not a.startswith(self.opening) or t["normalized"] for a, t in zip(added, spec["added_tokens"])):
            raise ValueError("added tokens of this kind are not supported")
        self.pattern = plain_pattern(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.of_byte = byte_symbols()
        self.plain: dict[str, int] = {}
        self.symbols: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[Counter, Counter, int]:
        """Pre-tokens as they stand in the text, pre-tokens in byte symbols, and special tokens of one text."""
        plain, symbols, specials = Counter(), Counter(), 0
        parts = [text]
        if self.special is not None and self.opening in text:
            parts = self.special.split(text)
            specials = len(parts) // 2
        for part in parts[::2]:
            if PLAIN.fullmatch(part):
                plain.update(self.pattern.findall(part.lower()))
            else:
                made = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                symbols.update(p for p, _ in made if p)
        return plain, symbols, specials

    def learn(self, plain: set[str], symbols: set[str]) -> None:
        """Counts of new pre-tokens, merged together."""
        order = list(plain)
        made = [p if p.isascii() else p.encode().decode("latin-1").translate(self.of_byte) for p in order]
        counts = self.merger.counts([*made, *symbols]).tolist()
        self.plain.update(zip(order, counts))
        self.symbols.update(zip(symbols, counts[len(order) :]))

    def tokens(self, texts: list[str | None]) -> list[int]:
        out, first = [], 0
        while first < len(texts):
            found, last, size = [], first, 0
            while last < len(texts) and size < CHUNK_BYTES:  # new pre-tokens of many texts are merged together
                found.append(self.pieces(texts[last] or ""))
                size += len(texts[last] or "")
                last += 1
            all_plain, all_symbols = (set().union(*[f[i] for f in found]) for i in (0, 1))
            new = {p for p in all_plain if p not in self.plain}, {p for p in all_symbols if p not in self.symbols}
            if len(self.plain) + len(self.symbols) + len(new[0]) + len(new[1]) > self.known_pieces:
                self.plain, self.symbols, new = {}, {}, (all_plain, all_symbols)
            self.learn(*new)
            one, two = self.plain, self.symbols
            for plain, symbols, specials in found:
                out.append(specials + sum(one[p] * n for p, n in plain.items()) + sum(two[p] * n for p, n in symbols.items()))
            first = last
        return out


@functools.lru_cache(maxsize=2)
def counter_of(path: str, known_pieces: int) -> WordCounter:
    return WordCounter(path, known_pieces)


def token_counts(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), known_pieces: int = KNOWN_PIECES) -> DataFrame:
    """The columns `keep`, n_bytes (UTF-8) and n_tokens of every row; `path` is the vocabulary file, there on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path, known_pieces)
        for batch in small_batches(batches):
            counts = counter.tokens(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])

    source = docs.select(*keep, F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), F.col("text").alias("n_tokens"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{schema}, n_tokens long")
