"""Secret scans: patterns of known forms, and random strings found by token efficiency.

Known forms are found by three patterns over the whole text. The method proper looks at
every long run of token characters: a tokenizer's vocabulary holds the pieces that
language is made of, so prose needs few tokens for many characters and a random string
needs many. A run whose characters per token stay below a threshold becomes a span of
kind `random`, unless it is a known digest (hex of a usual length), an identifier
(UUID, a number, a dotted or dashed date), or already covered by a span of a known form.
If spans of known forms cover a part of a run only, each stretch left is judged as a run.

Tokens are those of a tiktoken vocabulary; its path is a parameter. Runs are tokenized
once per task while they repeat. Nothing is shuffled: one pass over the documents.

Defined cases: a null or empty text has no spans. Positions are code points, ends are
exclusive, spans are ordered by start, then by kind in the order of KINDS. Overlapping
spans of different kinds all stay in `spans`; redaction merges them. Repeated rows are
scanned one by one; other columns are neither read nor touched.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from rivulet.llm import tokens, words as W

KINDS = ("assign", "access", "hex", "random")
SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

# fixed values: the known forms
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the longest run; shorter ones are dropped anyway
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: A run that may be random: long, of token characters.
RUN = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}={0,2}")
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_SIZES = frozenset({32, 40, 56, 64, 96, 128})
IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9_+/=-]+|[A-Za-z]{1,8}[-_]?[0-9]+"
)
THRESHOLD = 2.0  # characters per token below which a run counts as random


class Scanner:
    """Finds spans in one text after another; remembers the runs it has judged."""

    def __init__(self, vocabulary: str, threshold: float = THRESHOLD, most: int = 200_000):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            os.path.basename(vocabulary),
            pat_str=tokens.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self.threshold, self.most = threshold, most
        self.judged: dict[str, bool] = {}

    def random(self, run: str) -> bool:
        """Whether a run costs so many tokens that it can't be language."""
        known = self.judged.get(run)
        if known is None:
            known = self._judge(run)
            if len(self.judged) >= self.most:
                self.judged.clear()
            self.judged[run] = known
        return known

    def _judge(self, run: str) -> bool:
        core = run.strip("=_-+/")
        if len(core) < 16 or core.isdigit():
            return False
        if DIGEST.fullmatch(core) and len(core) in DIGEST_SIZES:
            return False
        if IDENTIFIER.fullmatch(core):
            return False
        return len(core) < self.threshold * len(self.encoding.encode_ordinary(core))

    def base(self, text: str) -> list[tuple[str, int, int]]:
        """Spans of the known forms, in order."""
        found = []
        if ":" in text or "=" in text:
            for m in ASSIGN.finditer(text):
                if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                    found.append(("assign", m.start(), m.end()))
        if "AKIA" in text:
            for m in ACCESS.finditer(text):
                if m.end() - m.start() >= ACCESS_LEAST:
                    found.append(("access", m.start(), m.end()))
        found.extend(("hex", m.start(), m.end()) for m in HEX.finditer(text))
        return _ordered(found)

    def spans(self, text: str) -> tuple[list, list]:
        """Spans of the known forms, and all spans."""
        base = self.base(text)
        more, covered, at = [], _covered(base), 0
        for m in RUN.finditer(text):
            while at < len(covered) and covered[at][1] <= m.start():
                at += 1  # runs come in order, so what lies behind one lies behind the next
            for start, end in _left(m.start(), m.end(), covered, at):
                if self.random(text[start:end]):
                    more.append(("random", start, end))
        return base, _ordered(base + more) if more else base


def _covered(spans: list) -> list[tuple[int, int]]:
    """The stretches that spans, ordered by start, cover together; apart and in order."""
    out: list[tuple[int, int]] = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _left(start: int, end: int, covered: list, at: int) -> Iterator[tuple[int, int]]:
    """What of a run is not covered; stretches ahead of `at` end before it."""
    while at < len(covered) and covered[at][0] < end:
        if start < covered[at][0]:
            yield start, covered[at][0]
        start = covered[at][1]
        at += 1
    if start < end:
        yield start, end


def _ordered(spans: list) -> list:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _structs(spans: list) -> list:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def scan(
    docs: DataFrame, vocabulary: str | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: spans of the known forms, and all spans."""
    vocabulary = vocabulary or tokens.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, threshold)
        for batch in W.slices(batches):
            found = [scanner.spans(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([_structs(base) for base, _ in found], _SPAN),
                    pa.array([_structs(spans) for _, spans in found], _SPAN),
                ],
                names=["doc_id", "base", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, base {SPAN}, spans {SPAN}")


def redact(
    docs: DataFrame,
    vocabulary: str | None = None,
    threshold: float = THRESHOLD,
    mark: str = "[SECRET]",
) -> DataFrame:
    """The documents with each stretch of spans replaced by a mark; all rows, all columns."""
    vocabulary = vocabulary or tokens.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, threshold)
        for batch in W.slices(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            clean = [t if not t else replaced(t, scanner.spans(t)[1], mark) for t in texts]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.column(at).type))

    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, spans: list, mark: str) -> str:
    out, done = [], 0
    reach = -1
    for _, start, end in spans:
        if start >= reach:  # else it runs on from the span before
            if reach >= 0:
                out.append(mark)
                done = reach
            out.append(text[done:start])
        reach = max(reach, end)
    if reach >= 0:
        out.append(mark)
        done = reach
    out.append(text[done:])
    return "".join(out)
