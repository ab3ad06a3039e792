"""SentencePiece ids and their decoded text, by a table of distinct chunks.

A chunk is a run of whitespace markers with the characters up to the next one.
When no piece of the vocabulary has a marker behind another character, no merge
can cross a chunk's start, so a text's ids are the ids of its chunks in order.
Every task segments each distinct chunk once, keeps its ids and its decoded
bytes in a table, and puts a document together by position from that table.

The table lives in the task: one table for the whole corpus, joined back by
position, would shuffle every word of every document.

Cases: a null text counts as empty; an empty text has only the begin and end
ids and decodes to the empty text; repeated rows repeat their result; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import documents

MARK = "▁"
# distinct chunks in one half of a task's table
TABLE_LIMIT = 300_000
_CHUNK = re.compile(" +[^ ]*")


class ChunkTable:
    """Ids and decoded text of every distinct chunk that was needed so far.

    A chunk is named by what follows its first marker; that marker is the
    library's own at the start of a text. When the table is full, its entries
    become the old half, from which used ones move back, so frequent chunks stay
    and memory is bounded. Forgotten chunks are segmented again.
    """

    def __init__(self, model_path: str, limit: int = TABLE_LIMIT):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.model, self.limit = model, limit
        self.ends = [struct.pack("<I", i) for i in (model.bos_id(), model.eos_id())]
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece of this vocabulary crosses a whitespace marker")
        if MARK not in pieces or model.decode(model.encode("  b  c ")) != "  b  c ":
            raise ValueError("this model does not keep white space")
        self.starts = np.array([p.startswith(MARK) for p in pieces])
        self.lone = {"": (struct.pack("<I", model.piece_to_id(MARK)), "")}
        self.known = dict(self.lone)
        self.old: dict[str, tuple[bytes, str]] = {}

    def _learn(self, chunks: list[str]) -> None:
        spaced = [c for c in chunks if c[:1] == " "]
        for chunk in spaced:
            ids = self.model.encode(chunk)
            # behind another id, so that decoding keeps all of the chunk's markers
            text = self.model.decode(self.model.encode("a") + ids)[2:]
            self.known[chunk] = (struct.pack(f"<{len(ids)}I", *ids), text)
        # chunks with a single marker are segmented in one call, as one text
        plain = [c for c in chunks if c[:1] != " "]
        if plain:
            found = self.model.encode(" ".join(plain))
            texts = self.model.decode(found).split(" ")
            ids = np.array(found, "<u4")
            packed = ids.tobytes()
            at = [*(4 * np.flatnonzero(self.starts[ids])).tolist(), len(packed)]
            for chunk, text, i, j in zip(plain, texts, at[:-1], at[1:], strict=True):
                self.known[chunk] = (packed[i:j], chunk if text == chunk else text)

    def encode(self, text: str) -> list[tuple[bytes, str]]:
        """Ids and text of each chunk of ``text``, in order."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            chunks = [c[1:] for c in _CHUNK.findall(" " + text)]
        else:
            chunks = text.split(" ")
        missing = set(chunks).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.limit:
                self.old, self.known = self.known, dict(self.lone)
                missing = set(chunks).difference(self.lone)
            back = {c: self.old[c] for c in missing if c in self.old}
            self.known.update(back)
            self._learn(list(missing.difference(back)))
        return list(map(self.known.__getitem__, chunks))

    def ids_of(self, chunks: list[tuple[bytes, str]]) -> bytes:
        """Little-endian unsigned 32-bit ids with the begin and the end id."""
        return b"".join([self.ends[0], *[c[0] for c in chunks], self.ends[1]])

    def decoded(self, chunks: list[tuple[bytes, str]]) -> str:
        """The text of the ids: the markers between the chunks are spaces."""
        return " ".join([c[1] for c in chunks])


def encoder(model_path: str, limit: int = TABLE_LIMIT):
    """A column function: text to ``ids`` (with both ends) and ``decoded`` (text)."""

    @F.pandas_udf("ids array<int>, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = ChunkTable(model_path, limit)
        for texts in batches:
            chunked = (table.encode(t or "") for t in texts)
            rows = [(np.frombuffer(table.ids_of(c), "<i4"), table.decoded(c)) for c in chunked]
            yield pd.DataFrame(rows, columns=["ids", "decoded"])

    return encode


def digester(model_path: str, limit: int = TABLE_LIMIT):
    """Like ``encoder``, but returns counts and digests instead of ids and texts."""

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = ChunkTable(model_path, limit)
        for texts in batches:
            rows = []
            for text in texts:
                chunks = table.encode(text or "")
                ids = table.ids_of(chunks)
                rows.append(
                    (
                        len(ids) // 4,
                        hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(table.decoded(chunks).encode()).hexdigest(),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: ``doc_id``, ``ids`` (array of ids with both ends) and ``decoded``."""
    return documents(docs).select("doc_id", encoder(model_path)("text").alias("r")).select("doc_id", "r.*")


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: number of ids and digests of the ids and of the decoded text."""
    return documents(docs).select("doc_id", digester(model_path)("text").alias("r")).select("doc_id", "r.*")
