"""Secrets in texts: three fixed patterns, and strings that a token vocabulary compresses badly."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from plantwatch.llm.common import freed, keeps, read_table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Least length of a string judged by its tokens, and the characters per token it stays under.
LEAST_CHARS = 20
CHARS_PER_TOKEN = 2.0
MARK = "[SECRET]"

# Fixed values.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_WORDY = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
#: Words of one case joined by underscores, hyphens or slashes, and words of three letters or more joined by case.
_JOINED = re.compile(r"[_/-]*+(?:(?=[A-Za-z0-9])(?:[A-Z]?[a-z]{0,12}|[A-Z]{1,12})[0-9]{0,4}(?:[_/-]++|$))+")
_CAMEL = re.compile(r"[a-z]{0,12}(?:[A-Z][a-z]{2,12})+[0-9]{0,4}")


@functools.cache
def token_counter(path: str | None):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(coder.encode_ordinary(text))


keeps(token_counter.cache_clear)


def looks_random(text: str, vocabulary: str | None) -> bool:
    """True for strings of few characters per token that are no digest and no identifier."""
    if text.isdigit() or _UUID.fullmatch(text):
        return False
    if len(text) in DIGEST_LENGTHS and _ALL_HEX.fullmatch(text):
        return False
    if _CAMEL.fullmatch(text) or (any(c in text for c in "_/-") and _JOINED.fullmatch(text)):
        return False
    return len(text) < CHARS_PER_TOKEN * token_counter(vocabulary)(text)


def secret_spans(text: str, vocabulary: str | None = None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) as (kind, start, end) by start, then kind as listed; code points, end exclusive.

    A kind's matches are leftmost and do not overlap. A string judged by its tokens is added where
    no base span touches it.
    """
    base = []
    if ":" in text or "=" in text:
        base += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        base += [("access", *m.span()) for m in ACCESS.finditer(text)]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    added = []
    for m in _WORDY.finditer(text):
        start, end = m.span()
        if not any(s < end and start < e for _, s, e in base) and looks_random(m[0], vocabulary):
            added.append(("random", start, end))
    order = lambda span: (span[1], KINDS.index(span[0]))
    return sorted(base, key=order), sorted(base + added, key=order)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for each row, null text as empty.

    Rows are independent: no shuffle. Repeated rows give repeated results, null doc_ids stay null,
    an empty table gives none, and further columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in schema.names[1:]}
            for text in batch.column("text"):
                base, every = secret_spans(text.as_py() or "", vocabulary)
                for kind in KINDS:
                    columns[f"n_{kind}"].append(sum(s[0] == kind for s in every))
                columns["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                columns["spans"].append(listed(every))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns}, schema)

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    wanted = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return wanted.mapInArrow(freed(run), f"doc_id bigint, {counts}, base_sha256 string, spans string")


def redact(text: str, vocabulary: str | None = None, mark: str = MARK) -> str:
    """The text with each stretch of touching spans replaced by ``mark``."""
    spans = secret_spans(text, vocabulary)[1]
    parts, at, i = [], 0, 0
    while i < len(spans):
        _, start, end = spans[i]
        while i < len(spans) and spans[i][1] <= end:
            end, i = max(end, spans[i][2]), i + 1
        parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, vocabulary: str | None = None, mark: str = MARK) -> DataFrame:
    """All rows and columns of docs; secrets in text are replaced and n_chars, if there, follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column("text").to_pylist()
            after = [t if t is None else redact(t, vocabulary, mark) for t in before]
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(after, pa.string()))
            if "n_chars" in batch.schema.names:
                given = batch.column("n_chars")
                counts = [n if a == b else len(a) for n, a, b in zip(given.to_pylist(), after, before)]
                out = out.set_column(batch.schema.get_field_index("n_chars"), "n_chars", pa.array(counts, given.type))
            yield out

    return docs.mapInArrow(freed(run), docs.schema)


def op5_secrets(spark, folder: str) -> DataFrame:
    return find_secrets(read_table(spark, folder, "documents"))
