"""Byte-pair encoding and decoding with a contiguous array of part boundaries and adjacent ranks.

The vocabulary file is the JSON of the public ``tokenizers`` library: NFC, white space folded, lower case, words split
by a pattern, bytes written as letters, an end-of-word suffix on the last part. A slice of texts is worked on as one
array of code points: words are cut by character class, each distinct word of the slice is merged once, and the ids are
laid out again in text order.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import keyed_text, slices
from inciscope.llm.shingles import run_hashes, same_runs

NO_RANK = np.iinfo(np.int32).max
#: Words of more parts are merged through a heap; rescanning the rank array would take quadratic time.
SHORT_PARTS = 128
#: Words merged together in one array.
ROWS_AT_ONCE = 4096
#: Code points worked on at a time.
SLICE_CHARS = 2_000_000

# Unicode white space. Python also counts U+001C to U+001F, the vocabulary's pattern does not.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
IN_SPACE, IN_LETTERS, IN_NUMBER, IN_OTHER = range(4)

#: The pattern this splitting follows; a vocabulary file with another one is refused.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
APOSTROPHE = ord("'")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of each code point: white space, letter, number or other."""
    classes = np.full(0x110000, IN_OTHER, dtype=np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, value in ((r"\p{L}+", IN_LETTERS), (r"\p{N}+", IN_NUMBER), (f"[{SPACE}]+", IN_SPACE)):
        for match in regex.finditer(pattern, everything):
            first = ord(match.group()[0])
            classes[first : ord(match.group()[-1]) + 1] = value
    return classes


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: Latin-1 where it is printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        if byte in plain:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class PairTable:
    """Rank of a pair of ids, looked up for whole arrays: two hashed tables, each pair in one of them."""

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, pairs: list[tuple[int, int]]):
        self.keys = np.array([k for k, _ in pairs] + [-1], dtype=np.int64)
        self.joined = np.array([j for _, j in pairs] + [-1], dtype=np.int64)
        self.bits = 20
        while not self._place():
            self.bits += 1

    def _slot(self, key: np.ndarray, table: int) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(self.MULTIPLIERS[table]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self) -> bool:
        """Each pair goes to the first table unless a later one has its slot there, then to the second."""
        none = len(self.keys) - 1
        self.slots = [np.full(1 << self.bits, none, dtype=np.int32) for _ in range(2)]
        left = np.arange(none)
        for table, slots in enumerate(self.slots):
            at = self._slot(self.keys[left], table)
            slots[at] = left
            left = left[slots[at] != left]
        return not len(left)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        rank = np.full(key.shape, NO_RANK, dtype=np.int32)
        for table, slots in enumerate(self.slots):
            found = slots[self._slot(key, table)]
            rank = np.where((self.keys[found] == key) & (b >= 0) & (a >= 0), found, rank)
        return rank


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = [(self.vocab[a] << 32 | self.vocab[b], self.vocab[a + b]) for a, b in merges]
        self.ranks = {pair: (rank, joined) for rank, (pair, joined) in enumerate(pairs)}
        self.table = PairTable(pairs)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if split["pattern"]["Regex"] != WORD_PATTERN:
            raise ValueError("words are split by another pattern than this encoder follows")
        self.odd_specials = any("<" not in t for t in self.special)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        known = max(self.tokens) + 1
        self.decimal = _string_table([str(i) for i in range(known)])
        self.token_text = _string_table([self.tokens.get(i, "") for i in range(known)])
        letters = byte_letters()
        self.first = np.array([self.vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([self.vocab[c + self.suffix] for c in letters], dtype=np.int64)

    def merge_words(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as byte ranges: all ids end to end, and how many each word has.

        The pair of lowest rank is merged, leftmost first, until none is left. Words of like length are worked on
        together. Each is a row of ``ids`` (its parts) and of ``at`` (``at[i]`` is the rank of joining parts i and i + 1).
        Every step finds each row's least rank, deletes that boundary from both arrays and refreshes the two ranks
        beside it; rows without a rank left are done.
        """
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 64, SHORT_PARTS):
            chosen = np.flatnonzero((lengths > low) & (lengths <= high))
            for lo in range(0, len(chosen), ROWS_AT_ONCE):
                rows = chosen[lo : lo + ROWS_AT_ONCE]
                self._merge_rows(rows, flat, starts[rows], lengths[rows], high, done)
            low = high
        for row in np.flatnonzero(lengths > SHORT_PARTS):
            data = flat[starts[row] : starts[row] + lengths[row]]
            ids = np.array(self.long_word([*self.first[data[:-1]].tolist(), int(self.last[data[-1]])]))[None]
            done.append((np.array([row]), ids, np.array([ids.shape[1]])))
        counts = np.zeros(len(starts), dtype=np.int64)
        for rows, _, n in done:
            counts[rows] = n
        offsets = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype=np.int32)
        for rows, ids, n in done:
            columns = np.arange(ids.shape[1])
            inside = columns < n[:, None]
            out[(offsets[rows][:, None] + columns)[inside]] = ids[inside]
        return out, counts

    def _merge_rows(self, rows, flat, starts, lengths, width: int, out: list) -> None:
        columns = np.arange(width)
        inside = columns < lengths[:, None]
        bytes_ = flat[np.where(inside, starts[:, None] + columns, 0)]
        ids = np.where(inside, self.first[bytes_], -1).astype(np.int64)
        ids[np.arange(len(rows)), lengths - 1] = self.last[bytes_[np.arange(len(rows)), lengths - 1]]
        ids = np.concatenate([ids, np.full((len(rows), 1), -1)], axis=1)  # a column that is never a part
        at = self.table.ranks(ids[:, :-1], ids[:, 1:])
        lengths = lengths.copy()
        while len(rows):
            i = at.argmin(axis=1)
            here = np.arange(len(rows))
            least = at[here, i]
            done = least == NO_RANK
            if done.any():
                out.append((rows[done], ids[done], lengths[done]))
                keep = ~done
                rows, ids, at, lengths, i, least = rows[keep], ids[keep], at[keep], lengths[keep], i[keep], least[keep]
                if not len(rows):
                    return
                here = np.arange(len(rows))
            ids[here, i] = self.table.joined[least]
            # delete boundary i + 1: parts behind it, and ranks from i on, move one to the left
            ids[:, :-1] = np.where(columns > i[:, None], ids[:, 1:], ids[:, :-1])
            at[:, :-1] = np.where(columns[:-1] >= i[:, None], at[:, 1:], at[:, :-1])
            at[:, -1] = NO_RANK
            lengths -= 1
            at[here, i] = self.table.ranks(ids[here, i], ids[here, i + 1])
            left = np.maximum(i - 1, 0)
            at[here, left] = np.where(i > 0, self.table.ranks(ids[here, left], ids[here, left + 1]), at[here, left])

    def long_word(self, ids: list[int]) -> list[int]:
        """The same merges for a word of many parts, in n log n."""
        n = len(ids)
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(r[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := self.ranks.get(a << 32 | b))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i] = self.ranks[a << 32 | b][1]
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := self.ranks.get(ids[left] << 32 | ids[right])):
                    heapq.heappush(heap, (r[0], left, ids[left], ids[right]))
        return [x for x, kept in zip(ids, alive) if kept]

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # letter by letter, as the library does: a final capital sigma gets no form of its own
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the end of each text's ids. Special tokens are cut out before anything else."""
        parts, owner, special_at = [], [], {}
        for k, text in enumerate(texts):
            at = 0
            for match in self.specials.finditer(text) if "<" in text or self.odd_specials else ():
                parts += [self.normal(text[at : match.start()]), ""]
                special_at[len(parts) - 1] = self.special[match.group()]
                owner += [k, k]
                at = match.end()
            parts.append(self.normal(text[at:]))
            owner.append(k)
        ids, ends = self._encode_parts(parts)
        counts = np.diff(ends, prepend=0)
        if special_at:
            ids = np.insert(ids, [ends[p] for p in special_at], list(special_at.values())).astype(np.int32)
            counts[list(special_at)] += 1
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return ids, np.cumsum(per_text)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_texts``, for normal text without special tokens."""
        joined = "\n".join([*parts, ""])
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kind = char_classes()[chars]
        start = np.empty(len(chars) + 1, dtype=bool)
        start[0] = True
        start[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == IN_NUMBER)
        start[-1] = True
        self._cut_contractions(chars, kind, start)
        borders = np.flatnonzero(start)
        begins, ends = borders[:-1], borders[1:]
        words = kind[begins] != IN_SPACE
        begins, ends = begins[words], ends[words]
        part_ends = np.cumsum([len(p) + 1 for p in parts])
        if not len(begins):
            return np.empty(0, np.int32), np.zeros(len(parts), np.int64)
        first, which = _distinct_words(chars, begins, ends)
        if len(joined) == len(data := joined.encode("utf-8")):
            byte_begin, byte_end = begins[first], ends[first]
        else:
            width = 1 + (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
            place = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
            byte_begin, byte_end = place[begins[first]], place[ends[first]]
        ids, counts = self.merge_words(np.frombuffer(data, np.uint8), byte_begin, byte_end - byte_begin)
        flat = ragged(ids, np.cumsum(counts) - counts, counts, which)
        last_word = np.searchsorted(begins, part_ends)
        return flat, np.concatenate([[0], np.cumsum(counts[which])])[last_word]

    @staticmethod
    def _cut_contractions(chars: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """An apostrophe alone before letters takes s, t, m, d, re, ve or ll into its word."""
        at = np.flatnonzero((chars[:-1] == APOSTROPHE) & start[:-2] & (kind[1:] == IN_LETTERS))
        one, two = chars[at + 1], chars[np.minimum(at + 2, len(chars) - 1)]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        at, size = at[single | double], np.where(single, 2, 3)[single | double]
        start[at + 1] = False
        start[at + size] = True

    def encode(self, text: str) -> list[int]:
        return self.encode_texts([text])[0].tolist()

    def decode(self, ids) -> str:
        """Tokens joined by one space; an id without a token is left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def _string_table(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all strings, each with a space after it; the offset and the length of each."""
    data = [f"{s} ".encode() for s in strings]
    counts = np.array([len(d) for d in data], dtype=np.int64)
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum(counts) - counts, counts


def _distinct_words(chars: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one word of each kind, and the kind of every word. Words are grouped by hash, and each is compared
    with the one that stands for its group; those that differ from it are told apart by their letters."""
    sizes = ends - begins
    _, first, which = np.unique(run_hashes(chars, begins, sizes), return_index=True, return_inverse=True)
    chosen = first[which]
    other = np.flatnonzero(~same_runs(chars, begins, sizes, chars, begins[chosen], sizes[chosen]))
    if len(other):
        kinds: dict[bytes, int] = {}
        more = []
        for k in other.tolist():
            word = chars[begins[k] : ends[k]].tobytes()
            if word not in kinds:
                kinds[word] = len(first) + len(more)
                more.append(k)
            which[k] = kinds[word]
        first = np.concatenate([first, more])
    return first, which


def ragged(values: np.ndarray, offsets: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``values[offsets[i] : offsets[i] + counts[i]]`` for each i in ``which``, end to end."""
    n = counts[which]
    shift = offsets[which] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(int(n.sum()))]


def by_chars(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` code points; a longer text stands alone."""
    lo = total = 0
    for k, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield lo, k
            lo, total = k, 0
        total += len(text)
    if lo < len(texts):
        yield lo, len(texts)


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One model for each worker process."""
    return Bpe(path)


def encoded_slices(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys, ids end to end and the end of each text's ids, for slices of (key, text)."""
    model = load(path)
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        for lo, hi in by_chars(texts):
            yield batch.column(0).slice(lo, hi - lo), *model.encode_texts(texts[lo:hi])


def joined_strings(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, counts: np.ndarray):
    """The string of each id and a space after it, end to end, and where each id's begins."""
    return ragged(data, offsets, counts, ids).tobytes(), np.concatenate([[0], np.cumsum(counts[ids])])


def _sha256(strings: tuple[bytes, np.ndarray], start: int, end: int) -> str:
    """Of the strings of ids from ``start`` to ``end``, without the last space."""
    data, place = strings
    return hashlib.sha256(memoryview(data)[place[start] : max(place[start], place[end] - 1)]).hexdigest()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): one row for each row of ``docs``. A null or empty text has no ids; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, ends in encoded_slices(batches, path):
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, lists], ["doc_id", "ids"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded): tokens joined by one space. Null or no ids give empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in slices(batches):
            texts = [model.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    source = encoded.select(encoded[id_col].cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, "doc_id long, decoded string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return digests of both.

    ``ids_sha256`` is of the decimal ids joined by one space, ``decoded_sha256`` of the decoded text. A null or empty
    text has no ids and the digests of empty text; repeated rows and null ids stay; an empty table gives an empty result;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for keys, ids, ends in encoded_slices(batches, path):
            starts = np.concatenate([[0], ends[:-1]])
            numbers = joined_strings(ids, *model.decimal)
            tokens = joined_strings(ids, *model.token_text)
            rows = [
                (int(e - s), _sha256(numbers, s, e), _sha256(tokens, s, e)) for s, e in zip(starts.tolist(), ends.tolist())
            ]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, DIGEST)
