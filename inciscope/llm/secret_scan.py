"""Secrets in text: fixed patterns, and strings in sensitive places that do not compress.

A candidate is a long string near a word such as ``key`` or ``token``. Its novelty is the number of bytes that zstandard
needs for it beyond what its surroundings take, with a dictionary of the identifiers that stand in such places in the
distinct texts of the whole corpus; what is a candidate itself gives none. An identifier is nearly free; a random string
costs about its length. Other occurrences of the candidate do not count as its surroundings, and every occurrence of a
novel string in its text is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import keyed_text, slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "novel")

#: Words that make a place sensitive.
SENSITIVE = re.compile(
    r"passw|passphrase|secret|token|api.?key|private.?key|access.?key|credential|bearer|authorization|signature",
    re.IGNORECASE | re.ASCII,
)
#: Every match of the two patterns above has one of these, so that most texts need no search by pattern.
GATES = ("passw", "passp", "secret", "token", "api", "key", "credential", "bearer", "authorization", "signature")
#: How far from such a word candidates and identifiers are looked for, in code points; see also ``candidates``.
REACH = 120
#: Candidates with no more than this between them belong together.
GAP = 4
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
LEAST_CANDIDATE = 16
IDENTIFIER = re.compile(r"[A-Za-z_]{3,40}")
#: The dictionary: at most this many identifiers, found in at least so many distinct texts.
DICTIONARY_IDENTIFIERS, DICTIONARY_DOCS = 4096, 2
#: Code points around a candidate that count as its surroundings.
AROUND = 300
#: Marginal bytes for each character from which a string is novel.
NOVEL_RATIO = 0.7
LEVEL = 9

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,value:string,marginal_bytes:int>>"


def gated(text: str) -> bool:
    lower = text.lower()
    return any(gate in lower for gate in GATES)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, not overlapping within a kind; failing matches are dropped and not tried again."""
    assigned = ASSIGN.finditer(text) if gated(text) else ()
    found = [("assign", *m.span()) for m in assigned if len(m.group(2)) >= LEAST_ASSIGNED]
    # runs are taken whole, so the length may stand in the pattern: a shorter run has no longer one inside
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def windows(text: str) -> list[tuple[int, int]]:
    """The stretches around sensitive words, those that touch joined."""
    out: list[tuple[int, int]] = []
    for match in SENSITIVE.finditer(text) if gated(text) else ():
        start, end = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def is_candidate(value: str) -> bool:
    """Whether a string is long and mixes letters with digits or capitals with small letters."""
    return len(value) >= LEAST_CANDIDATE and sum(any(map(test, value)) for test in (str.isdigit, str.islower, str.isupper)) >= 2


def near_runs(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[int]]:
    """The windows of a text, its runs of letters, and the numbers of the runs that reach into a window."""
    around = windows(text)
    runs = [m.span() for m in RUN.finditer(text)] if around else []
    ends = [end for _, end in runs]
    near: list[int] = []
    for first, last in around:
        k = max(bisect_right(ends, first), near[-1] + 1 if near else 0)
        while k < len(runs) and runs[k][0] < last:
            near.append(k)
            k += 1
    return around, runs, near


def candidates(text: str) -> list[list[tuple[int, int]]]:
    """Candidates that reach into a window, and those that follow or go before one with no more than ``GAP`` between:
    the lines of a key block, the parts of a dotted token. Those that belong together are in one list."""
    _, runs, near = near_runs(text)
    picked = {k for k in near if is_candidate(text[slice(*runs[k])])}
    for step in (1, -1):
        for k in sorted(picked):
            k += step
            while 0 <= k < len(runs) and k not in picked:
                between = runs[k][0] - runs[k - 1][1] if step > 0 else runs[k + 1][0] - runs[k][1]
                if between > GAP or not is_candidate(text[slice(*runs[k])]):
                    break
                picked.add(k)
                k += step
    out: list[list[tuple[int, int]]] = []
    for k in sorted(picked):
        if k - 1 in picked and runs[k][0] - runs[k - 1][1] <= GAP:
            out[-1].append(runs[k])
        else:
            out.append([runs[k]])
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span overlaps one of those that ``merged`` gives."""
    at = bisect_left(taken, (end, 0)) - 1
    return at >= 0 and taken[at][1] > start


def outside(taken: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a span that none of those that ``merged`` gives covers."""
    out = []
    k = max(0, bisect_left(taken, (start, 0)) - 1)
    while k < len(taken) and taken[k][0] < end:
        if taken[k][0] > start:
            out.append((start, taken[k][0]))
        start = max(start, taken[k][1])
        k += 1
    return [*out, (start, end)] if start < end else out


def identifiers_of(text: str) -> set[str]:
    """The identifiers around sensitive words that are no part of a candidate."""
    found: set[str] = set()
    around, runs, near = near_runs(text)
    plain = [runs[k] for k in near if not is_candidate(text[slice(*runs[k])])]
    starts = [start for start, _ in plain]
    for first, last in around:
        k = max(0, bisect_right(starts, first) - 1)
        while k < len(plain) and plain[k][0] < last:
            found.update(IDENTIFIER.findall(text, max(first, plain[k][0]), max(first, min(last, plain[k][1]))))
            k += 1
    return found


def identifiers(docs: DataFrame) -> list[str]:
    """The identifiers found around sensitive words of the most distinct texts, the most frequent last.

    Texts of the same 64-bit hash count as one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(key, "\n".join(sorted(w))) for key, text in zip(*(c.to_pylist() for c in batch.columns)) if (w := identifiers_of(text))]
            keys, joined_words = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(joined_words, pa.string())], ["key", "words"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: Counter[str] = Counter()
            for words in batch.column(0).to_pylist():
                counts.update(words.split("\n"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "docs"]
            )

    found = docs.select(F.xxhash64("text").alias("key"), "text").mapInArrow(find, "key long, words string")
    distinct = found.groupBy("key").agg(F.first("words").alias("words")).select("words")
    counted = distinct.mapInArrow(count, "word string, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    common = counted.where(F.col("docs") >= DICTIONARY_DOCS)
    top = common.orderBy(F.desc("docs"), "word").limit(DICTIONARY_IDENTIFIERS).collect()
    return [r["word"] for r in reversed(top)]


def occurrences(text: str, value: str, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Places of a string that reach into a stretch of the text, not overlapping."""
    at = text.find(value, max(0, first - len(value) + 1), last + len(value) - 1)
    while at >= 0:
        yield at, at + len(value)
        at = text.find(value, at + len(value), last + len(value) - 1)


def repeats(text: str, values: set[str]) -> Iterator[tuple[int, int]]:
    """Places of any of the strings in one pass, but for those inside the place before; they are found by their heads."""
    heads: dict[str, list[str]] = {}
    for value in sorted(values, key=len, reverse=True):
        heads.setdefault(value[:LEAST_CANDIDATE], []).append(value)
    finder = ahocorasick.Automaton()
    for head, own in heads.items():
        finder.add_word(head, (len(head), own))
    done = 0
    if heads:
        finder.make_automaton()
        for last, (size, own) in finder.iter(text):
            at = last + 1 - size
            value = next((v for v in own if at + len(v) > done and text.startswith(v, at)), "")
            if value:
                done = at + len(value)
                yield at, done


def without(text: str, first: int, last: int, values: list[str]) -> str:
    """A stretch of the text, of which all that belongs to one of the strings is left out."""
    out, at = [], first
    for start, end in merged([span for value in values for span in occurrences(text, value, first, last)]):
        out.append(text[at : max(at, start)])
        at = end
    return "".join([*out, text[at:last]])


class Novelty:
    def __init__(self, words: list[str]):
        data = "\n".join(words).encode()
        # zstandard takes no dictionary of fewer than eight bytes
        primed = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(data) >= 8 else None
        if primed:
            primed.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=primed, write_content_size=False, write_dict_id=False
        )

    def marginal(self, text: str, start: int, end: int) -> int:
        """Bytes that the string adds to its compressed surroundings, from which it is taken out itself, as is what
        stands behind or before an equals sign in it."""
        value = text[start:end]
        values = [value, *(part for part in value.split("=") if LEAST_CANDIDATE <= len(part) < len(value))]
        before = without(text, max(0, start - AROUND), start, values)
        after = without(text, end, min(len(text), end + AROUND), values)
        around = f"{before}\n{after}\n".encode()
        whole = len(self.compressor.compress(around + value.encode()))
        return whole - len(self.compressor.compress(around))


def is_novel(marginal: int, size: int) -> bool:
    return marginal >= NOVEL_RATIO * size


def all_spans(text: str, novelty: Novelty) -> list[tuple[str, int, int, str, int | None]]:
    """(kind, start, end, value, marginal bytes) by start, then kind. Of candidates that belong together one
    novel makes all so. Of one that base spans cover in part the rest is judged; where a span of hexadecimal digits or an access key stands inside a novel string, its short ends are
    reported too. A string found novel is reported wherever it stands in the text."""
    spans = [(kind, start, end, text[start:end], None) for kind, start, end in base_spans(text)]
    taken = merged([(start, end) for _, start, end, _, _ in spans])
    open_ended = {x for kind, start, end, _, _ in spans if kind in ("hex", "access") for x in (start, end)}
    novel: dict[tuple[int, int], int] = {}
    for chain in candidates(text):
        judged: dict[tuple[int, int], int] = {}
        for start, end in chain:
            pieces = outside(taken, start, end)
            whole = novelty.marginal(text, start, end) if pieces else 0
            for first, last in pieces:
                if (first, last) == (start, end) or is_candidate(text[first:last]):
                    judged[first, last] = whole if (first, last) == (start, end) else novelty.marginal(text, first, last)
                elif is_novel(whole, end - start) and last - first < LEAST_CANDIDATE and open_ended & {first, last}:
                    novel[first, last] = whole
        if any(is_novel(marginal, last - first) for (first, last), marginal in judged.items()):
            novel |= judged
    held = merged(list(novel))
    for span in repeats(text, {text[slice(*span)] for span in novel if span[1] - span[0] >= LEAST_CANDIDATE}):
        if not overlaps(taken, *span) and not overlaps(held, *span):
            novel[span] = novelty.marginal(text, *span)
    spans += [("novel", start, end, text[start:end], marginal) for (start, end), marginal in novel.items()]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all spans of each row by start, then kind; ``marginal_bytes`` only of novel ones.

    Novel spans are added outside base spans, at every occurrence of a novel string. A null or empty text has none; the
    time is linear in a text's length, long runs without a break included; repeated rows and rows without doc_id are
    scanned one by one; an empty table gives an empty result; other columns are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)
    words = identifiers(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        for batch in slices(batches):
            out = [
                [dict(zip(("kind", "start", "end", "value", "marginal_bytes"), x)) for x in all_spans(text, novelty)]
                for text in batch.column(1).to_pylist()
            ]
            kind = pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()),
                 ("marginal_bytes", pa.int32())]
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(kind))], ["doc_id", "spans"])

    return keyed.mapInArrow(run, SPANS)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their places, and the places of all spans."""
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")
    )


def redacted(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with each span, or run of overlapping ones, replaced by the mark."""
    out, at = [], 0
    for start, end in merged(spans):
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with each secret replaced by the mark, and the length of the text, if there is
    such a column, set anew where the text changed. A null text stays null; rows stay where they are."""
    words = identifiers(docs.select(F.lit(0).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")))
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        for batch in slices(batches):
            columns, texts = list(batch.columns), batch.column(at).to_pylist()
            found = [[(s, e) for _, s, e, _, _ in all_spans(t, novelty)] if t else [] for t in texts]
            new = [redacted(t, spans, mark) if spans else t for t, spans in zip(texts, found)]
            columns[at] = pa.array(new, columns[at].type)
            if length_at is not None:
                lengths = zip(new, found, columns[length_at].to_pylist())
                columns[length_at] = pa.array([len(t) if s else n for t, s, n in lengths], columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
