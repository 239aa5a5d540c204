"""SentencePiece ids by a table of distinct chunks.

In the vocabularies this takes, no piece holds a blank marker behind another character, so a merge never
crosses the place where a blank follows a word. Texts are cut there into chunks (blanks with the word
behind them), and again around line ends, which no piece holds. Within a task, each distinct chunk of a
bounded run of documents is segmented once by the library, and ids come back to every place a chunk
stands at by array indexing. The table of chunks lives from run to run and is started anew at a fixed size.

Decoding goes the other way: ids index a table of piece bytes. Ids that such a table cannot express
(unknown pieces, byte pieces that make no UTF-8) are decoded by the library's own ``decode``.
Texts: null is empty; every text gets the begin and end id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.llm.common import pieces_of, table, with_text

MARK = "▁"
TABLE_CHUNKS = 80_000  # distinct chunks a task remembers
CHUNK = re.compile(r" *[^ \n]+| +|\n")


class Pieces:
    """One tokenizer with its table of chunks."""

    def __init__(self, model: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.lib.get_piece_size()
        pieces = [self.lib.id_to_piece(i) for i in range(size)]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("pieces of this model cross blank markers or line ends: chunks cannot be told apart")
        probe = self.lib.encode(["a  b", " a", "\n"])
        if self.lib.decode(probe[0]) != "a  b" or self.lib.decode(probe[1]) != " a" or probe[2][-1] != self.lib.piece_to_id("<0x0A>"):
            raise ValueError("this model changes blanks or has no byte pieces: chunks cannot be put together again")
        self.lead = len(self.lib.encode("\n"))
        self.bos, self.eos = self.lib.bos_id(), self.lib.eos_id()
        raw = [
            bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else b"" if self.lib.is_control(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.unknown = self.lib.unk_id()
        self.size = np.array([len(r) for r in raw], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.at = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids end."""
        if len(self.code) > TABLE_CHUNKS:
            self._clear()
        code, fresh, codes, ends = self.code, [], [], []
        for text in texts:
            # The library writes one blank before any text that is not empty.
            for chunk in CHUNK.findall(" " + text.replace(MARK, " ")) if text else ():
                k = code.get(chunk)
                if k is None:
                    k = code[chunk] = len(code)
                    fresh.append(chunk)
                codes.append(k)
            ends.append(len(codes))
        if fresh:
            # A line end in front keeps the library's own blank apart from the chunk.
            got = self.lib.encode(["\n" + c for c in fresh])
            lengths = np.array([len(g) - self.lead for g in got], dtype=np.int64)
            flat = np.fromiter((i for g in got for i in g[self.lead :]), dtype=np.uint32, count=int(lengths.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        places = np.array(codes, dtype=np.int64)
        ids, stops = _gather(self.ids, self.at[places], self.at[places + 1] - self.at[places])
        return ids, np.concatenate([[0], stops])[np.array(ends, dtype=np.int64)]

    def decode(self, ids: np.ndarray) -> str:
        """What the library's ``decode`` gives."""
        if not (ids == self.unknown).any():
            raw, _ = _gather(self.raw, self.start[ids], self.size[ids])
            try:
                text = raw.tobytes().decode()
                return text[1:] if text.startswith(" ") else text
            except UnicodeDecodeError:
                pass
        return self.lib.decode(ids.tolist())


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[start : start + size]`` one after the other, and where each ends."""
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    shift = np.repeat(start - (stops - size), size)
    return values[np.arange(total) + shift], stops


LOADED: dict[str, Pieces] = {}


def loaded(model: str) -> Pieces:
    """The tokenizer of this Python worker."""
    if model not in LOADED:
        LOADED[model] = Pieces(model)
    return LOADED[model]


def _encoder(model: str, want: list[str], text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in pieces_of(batches, text):
            ids, ends = pieces.encode(batch.column(text).to_pylist())
            out = {name: [] for name in want}
            low = 0
            for end in ends.tolist():
                own = np.concatenate([[pieces.bos], ids[low:end], [pieces.eos]]).astype("<u4")
                low = end
                if "ids" in out:
                    out["ids"].append(own.astype(np.int32))
                if "n_tokens" in out:
                    out["n_tokens"].append(len(own))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(hashlib.sha256(own.tobytes()).hexdigest())
                if "decoded_sha256" in out:
                    out["decoded_sha256"].append(hashlib.sha256(pieces.decode(own).encode()).hexdigest())
                if "decoded" in out:
                    out["decoded"].append(pieces.decode(own))
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            kept = batch.select(keep)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *[pa.array(out[n], kinds.get(n, pa.string())) for n in want]], names=[*kept.schema.names, *want]
            )

    return run


TYPES = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encoded(docs: DataFrame, model: str, want: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with the columns named in ``want`` (see TYPES); columns of these names are replaced.

    ``model`` is a path that every executor has.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in want]
    rows, name = with_text(docs, kept, text)
    schema = T.StructType([*rows.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, *[T.StructField(n, T._parse_datatype_string(TYPES[n])) for n in want]])
    return rows.mapInArrow(_encoder(model, want, name, kept), schema)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), ["n_tokens", "ids_sha256", "decoded_sha256"], keep=["doc_id"])
