"""Encoding of the whole corpus with a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import driver_folder, spread
from .transducer import Transducer, build

#: Folder of the public vocabulary files.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: how byte_bpe_50k cuts a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cut in Java's syntax, for counting only.
COUNT_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merges of one word, least rank first, leftmost first among equals; n log n in its length."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    n = len(parts)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        a = parts[i]
        j = right[i]
        if a is None or j >= n or parts[j] is None or len(a) + len(parts[j]) != size:
            continue
        parts[i] = a + parts[j]
        parts[j] = None
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[k])))
        if (h := left[i]) >= 0 and (r := ranks.get(parts[h] + parts[i])) is not None:
            heapq.heappush(heap, (r, h, len(parts[h]) + len(parts[i])))
    return [ranks[p] for p in parts if p is not None]


def merger(ranks: dict[bytes, int]):
    """word -> ids: the public library's exact merge where it is installed, else the one above."""
    try:
        import tiktoken

        one = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        return lambda word: one(word)
    except (ImportError, AttributeError):
        return lambda word: merge(word, ranks)


def frequent_words(docs: DataFrame, least: int = 2, least_share: float = 5e-6) -> DataFrame:
    """(word, n) of the words that make up at least ``least_share`` of all: at most 1 / least_share of them at any size.

    Counted over all documents; the hash aggregate combines each task's words before the shuffle.
    """
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(COUNT_PATTERN), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.where(F.col("n") >= least).join(F.broadcast(total)).where(F.col("n") >= least_share * F.col("total")).select("word", "n")


def compile_lexicon(docs: DataFrame, ranks: dict[bytes, int], folder: str | None = None) -> str:
    """Compiles the frequent words of the corpus and gives the file to all executors; returns its name there."""
    one = merger(ranks)
    words = sorted({r.word.encode() for r in frequent_words(docs).toLocalIterator()} - {b""})
    to = (Path(folder) if folder else driver_folder(docs.sparkSession)) / "lexicon.bin"
    build(((w, one(w)) for w in words), to)
    named = to.rename(to.with_name(f"lexicon-{uuid.uuid4().hex}.bin"))  # a session may compile the same corpus again
    docs.sparkSession.sparkContext.addFile(str(named))
    return named.name


def encode(docs: DataFrame, ranks_file: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row, without special tokens.

    Null and empty texts have an empty list; a blank text is encoded as any other. Special tokens' strings in a text are ordinary text.
    Words in the lexicon take their ids from the mapped transducer, others are merged exactly; the result doesn't depend on
    what is in the lexicon. Repeated rows are encoded each; texts of any length are encoded whole.
    """
    docs = spread(docs.select("doc_id", "text"))
    ranks = read_ranks(ranks_file)
    context = docs.sparkSession.sparkContext
    table = context.broadcast(ranks)  # the fixed vocabulary
    name = compile_lexicon(docs.where("text is not null"), ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Transducer(SparkFiles.get(name)).get
        one = merger(table.value)
        cut = regex.compile(PATTERN).findall
        seen: dict[str, list[int]] = {}
        for batch in batches:
            out, offsets = [], [0]
            for text in batch.column("text").to_pylist():
                for word in cut(text) if text else ():
                    ids = seen.get(word)
                    if ids is None:
                        raw = word.encode()
                        if (ids := lexicon(raw)) is None:
                            ids = one(raw)
                        if len(seen) >= 300_000:  # a cache, not a limit
                            seen.clear()
                        if len(raw) < 200:
                            seen[word] = ids
                    out += ids
                offsets.append(len(out))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id bigint, ids array<int>")
