"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model has a whitespace marker behind another character (checked when the model is loaded), so no merge crosses the place
where a run of markers begins. The normalised text splits there into chunks; each distinct chunk is segmented once for a slice of rows
(and kept for the next slices, up to a bound), and ids are joined back by position. Decoding works on the same table: byte pieces of a
character lie in one chunk, and only the first marker of the text is dropped.

Null text counts as empty: no ids, empty decoded text. Rows are independent, and repeated rows give repeated results. An empty table gives
an empty result. Own columns whose names clash with those added stay under the name ``own`` and theirs. A very long text is encoded whole,
in some 50 bytes a word. The model file must be readable on every executor.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import arrow_schema, bounded, clear_of, ddl, plainly, quoted, resident, slices, uncollected

_MARK = "▁"
_CHUNK = re.compile(r" +[^ ]*")
#: Chunks kept by a worker; beyond that only those of the rows at hand stay.
TABLE_SIZE = 250_000
#: Text bytes that are looked up at once: a distinct chunk is then segmented once for more rows.
_SLICE = 2 << 20

def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Segmenter:
    def __init__(self, model: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        if any(_MARK in sp.id_to_piece(i).lstrip(_MARK) for i in range(sp.get_piece_size())):
            raise ValueError("a piece of this model crosses a whitespace marker; chunks can't be segmented alone")
        if sp.encode("a") != sp.encode(["a"])[0] or sp.normalize("  a\n b ") != _MARK * 3 + "a\n" + _MARK + "b" + _MARK:
            raise ValueError("this model's normalisation changes more than spaces")
        self.lone = sp.piece_to_id(_MARK)
        size = sp.get_piece_size()
        self.digits = [str(i) for i in range(size)]
        #: What an id decodes to alone; none for bytes and control ids.
        self.surface = [None if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i) for i in range(size)]
        #: Of each chunk, without its first marker and with spaces for others: ids as text, their number, and what they decode to if not itself.
        self.table: dict[str, tuple[str, int, str | None]] = {}

    def chunks(self, text: str) -> list[str]:
        """Chunks without their first marker, spaces standing for markers: what the library is given for each."""
        if _MARK in text:
            text = text.replace(_MARK, " ")
        if not text or (text[0] != " " and "  " not in text):
            return text.split(" ") if text else []
        return [c[1:] for c in _CHUNK.findall(" " + text)]

    def ids(self, chunk: str) -> list[int]:
        # the library puts the first marker back itself, but returns nothing for an empty text
        return self.sp.encode(chunk) if chunk else [self.lone]

    def look_up(self, texts: list[str | None]) -> list[tuple[list[str], list[tuple[str, int, str | None]]]]:
        """The chunks of each text and their entries in the table; chunks that it lacks are segmented once."""
        with uncollected():
            return self._look_up(texts)

    def _look_up(self, texts):
        rows, new = [], set()
        for t in texts:
            chunks = self.chunks(t or "")
            got = list(map(self.table.get, chunks))
            if None in got:
                new.update([c for c, x in zip(chunks, got, strict=True) if x is None])
                got = None
            rows.append([chunks, got])
        more = self.segmented(list(new))
        if len(self.table) + len(more) > TABLE_SIZE:
            wanted = set().union(*(chunks for chunks, _ in rows))
            self.table = {c: x for c, x in self.table.items() if c in wanted}
        self.table.update(more)
        find = self.table.__getitem__
        return [(chunks, list(map(find, chunks)) if got is None else got) for chunks, got in rows]

    def segmented(self, chunks: list[str]) -> dict[str, tuple[str, int, str | None]]:
        digit, surface, with_bytes, out = self.digits.__getitem__, self.surface.__getitem__, [], {}
        for c, ids in zip(chunks, self.sp.encode(chunks, num_threads=1), strict=True):
            ids = ids if c else [self.lone]
            parts = list(map(surface, ids))
            if None in parts:
                with_bytes.append((c, ids))
            else:
                text = "".join(parts)[1:]
                out[c] = ",".join(map(digit, ids)), len(ids), None if text == c else text.replace(_MARK, " ")
        for (c, ids), text in zip(with_bytes, self.sp.decode([ids for _, ids in with_bytes], num_threads=1) if with_bytes else [], strict=True):
            out[c] = ",".join(map(digit, ids)), len(ids), None if text == c else text
        return out


def text_of(chunks: list[str], got: list[tuple[str, int, str | None]]) -> str:
    """The decoded text of a row: its chunks' texts, a space for the first marker of each but the first."""
    return " ".join([c if x[2] is None else x[2] for c, x in zip(chunks, got, strict=True)])


def segmenter(model: str) -> Segmenter:
    return resident("pieces", model, lambda: Segmenter(model))


def _sliced(df: DataFrame, id_column: str, text: str, model: str | None, columns: str, row) -> DataFrame:
    model = model or default_model()
    schema = f"{id_column} {df.schema[id_column].dataType.simpleString()}, {columns}"
    names, types = zip(*[(f.name, f.type) for f in arrow_schema(schema)], strict=True)

    def run(batches):
        work = segmenter(model)
        for part in slices(batches, text, _SLICE):
            out = [row(*got) for got in work.look_up(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types[1:], strict=True))], list(names))

    return bounded(df).select(id_column, text).mapInArrow(run, schema)


def encode(df: DataFrame, id_column: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """(id, ids array<int>, decoded string) for every row."""

    def row(chunks, got):
        return [int(i) for x in got for i in x[0].split(",")], text_of(chunks, got)

    return _sliced(df, id_column, text, model, "ids array<int>, decoded string", row)


def with_ids(df: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """The rows without ``text``, with n_tokens and ids array<int> (own columns of these names, in either case, become ``own n_tokens`` and the like)."""
    model = model or default_model()
    df, _ = clear_of(df, ["n_tokens", "ids"])
    keep = [c for c in df.columns if c != text]
    schema = ", ".join([ddl(df.select(*map(quoted, keep))), "n_tokens long, ids array<int>"])
    target = arrow_schema(schema)

    def run(batches):
        work = segmenter(model)
        for part in slices(batches, f"c{len(keep)}", _SLICE):
            rows = work.look_up(part.column(len(keep)).to_pylist())
            ids = [np.fromstring(",".join([x[0] for x in got]), np.int32, sep=",") if got else np.zeros(0, np.int32) for _, got in rows]
            sizes = np.array([len(i) for i in ids])
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            flat = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(sizes), flat.cast(target.field("ids").type)], schema=target)

    return plainly(bounded(df), [*keep, text]).mapInArrow(run, schema)


def digest(df: DataFrame, id_column: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """The digest columns of op5, made from the same table without building the arrays."""

    def row(chunks, got):
        return sum([x[1] for x in got]), hashlib.sha256(",".join([x[0] for x in got]).encode()).hexdigest(), hashlib.sha256(text_of(chunks, got).encode()).hexdigest()

    return _sliced(df, id_column, text, model, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
