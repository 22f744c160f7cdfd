"""Secret scans: known forms of secrets, and random strings that tokenize badly.

Known forms (``assign``, ``access``, ``hex``) are found by pattern, leftmost and not
overlapping per kind. The token-efficiency test adds spans of kind ``random``: a string of
``MIN_LENGTH`` or more of the characters secrets are written in whose number of characters per
token, under a byte-pair vocabulary, is at most ``MAX_RATIO``. Text of any language is made of
pieces the vocabulary knows; random strings fall apart into one or two characters per token.

The test is made on a whole run of such characters, on its parts between ``= / _ -``, and on
every stretch of ``MIN_LENGTH`` characters (to the end of a token), so readable words before or
after a random string do not hide it. A part is taken whole if half of it or more is in such
stretches; of a longer one only the stretches are.

Not random are what is known to look so: digests (hexadecimal strings of the lengths of MD5,
SHA-1, SHA-256 and SHA-512) and UUIDs, as a run or as parts of one, and strings without a
letter. They are left out of the added kind only; patterns above keep finding them.

A missing text is empty. Rows are handled one by one, so repeated rows get equal results.
Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 20
MAX_RATIO = 1.9
VOCABULARY = "byte_bpe_50k.tiktoken"
MASK = "[secret]"

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")       # shorter runs fail; a run is taken whole either way
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_KNOWN = re.compile(      # digests and UUIDs that other letters and digits do not go on
    r"(?i)(?<![0-9a-z+])(?:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128})(?![0-9a-z+])")
_PART = re.compile(r"[^=/_-]+")
_LETTER = re.compile(r"[A-Za-z]")


@functools.cache
def _encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path(vocabulary), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def known_forms(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of secrets of known form, by start and kind."""
    spans = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= 16]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _random_parts(value: str, max_ratio: float, vocabulary: str) -> list[tuple[int, int]]:
    """Places of random strings in a run without digests and UUIDs, in order."""
    if len(value) < MIN_LENGTH or not _LETTER.search(value):
        return []
    encoding = _encoding(vocabulary)
    ids = encoding.encode_ordinary(value)
    if len(value) <= max_ratio * len(ids):
        return [(0, len(value))]
    at = [0]
    for piece in encoding.decode_tokens_bytes(ids):
        at.append(at[-1] + len(piece))
    hidden, j = [], 0         # stretches that fail the test, not overlapping, in order
    for i, start in enumerate(at):
        while j < len(at) and at[j] - start < MIN_LENGTH:
            j += 1
        if j == len(at):
            break
        if at[j] - start <= max_ratio * (j - i) and _LETTER.search(value, start, at[j]):
            if hidden and start <= hidden[-1][1]:
                hidden[-1][1] = at[j]
            else:
                hidden.append([start, at[j]])
    out, k = [], 0
    for part in _PART.finditer(value):
        begin, end = part.span()
        while k < len(hidden) and hidden[k][1] <= begin:
            k += 1
        inside, n = [], k
        while n < len(hidden) and hidden[n][0] < end:
            inside.append((max(begin, hidden[n][0]), min(end, hidden[n][1])))
            n += 1
        whole = 2 * sum(b - a for a, b in inside) >= end - begin
        if not whole and end - begin >= MIN_LENGTH and _LETTER.search(part[0]):
            whole = end - begin <= max_ratio * len(encoding.encode_ordinary(part[0]))
        # Less than half of a part is random: a stretch that only reaches into it is left out.
        found = [(begin, end)] if whole else [s for s in inside if s[1] - s[0] >= MIN_LENGTH]
        for a, b in found:
            # Parts of one random string are one span, with what stands between them.
            if out and any(x <= out[-1][1] and a <= y for x, y in hidden[max(0, k - 1):k + 1]):
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    return out


def random_strings(text: str, max_ratio: float = MAX_RATIO,
                   vocabulary: str = VOCABULARY) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of strings with few characters per token."""
    spans = []
    for m in _CANDIDATE.finditer(text):
        at = m.start()
        for known in [*_KNOWN.finditer(m[0]), None]:
            end = m.start() + known.start() if known else m.end()
            spans += [(at + a, at + b, "random")
                      for a, b in _random_parts(text[at:end], max_ratio, vocabulary)]
            at = m.start() + known.end() if known else end
    return spans


def all_spans(text: str, **options) -> list[tuple[int, int, str]]:
    return sorted(known_forms(text) + random_strings(text, **options),
                  key=lambda s: (s[0], KINDS.index(s[2])))


def masked(text: str, spans: list[tuple[int, int, str]], mask: str = MASK) -> str:
    """``text`` with every stretch covered by spans replaced by ``mask``."""
    out, at = [], 0
    reach = -1
    for start, end, _ in spans:
        if start >= reach:
            out += [text[at:start], mask]
        at = reach = max(reach, end)
    return "".join(out) + text[max(at, 0):]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """``id, spans``: the spans of each text as an array of ``start, end_, kind``.

    Options: ``max_ratio``, ``vocabulary``.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end_", pa.int64()),
                               ("kind", pa.string())]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("start", "end_", "kind"), s))
                      for s in all_spans(text.as_py(), **options)]
                     for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)],
                                             names=["id", "spans"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        emit, f"id {id_type}, spans array<struct<start:long,end_:long,kind:string>>")


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = MASK,
                 **options) -> DataFrame:
    """``docs`` with the secrets in column ``text_col`` masked; missing texts stay missing."""
    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            spans = all_spans(text, **options) if text else []
            out.append(masked(text, spans, mask) if spans else text)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col)))


def span_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """Column: the spans of ``kinds``, joined as ``kind:start:end``."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end_"])), ",")
