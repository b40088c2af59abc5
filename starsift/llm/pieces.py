"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the vocabulary has a white-space marker after another character (checked when the model is loaded), so no
piece leaves a chunk "markers, then characters up to the next marker". Each distinct chunk is segmented once, and the
ids of a text are those of its chunks joined by position. A model that breaks the condition, or that rewrites text
before segmenting, is refused rather than encoded wrongly.
"""

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from starsift.llm.chunks import ChunkTable, kept
from starsift.llm.shared import per_batch, runs

#: Entries hold id lists, about 600 bytes each.
ENTRIES = 300_000
MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any(MARK in m.id_to_piece(i).lstrip(MARK) for i in range(m.get_piece_size()))
        kept = m.encode_as_pieces("a  Å") == m.encode_as_pieces(f"a{MARK}{MARK}Å") and m.decode(m.encode(" a  Å ")) == " a  Å "
        if inner or not kept:
            raise ValueError(f"{path}: pieces can cross white-space markers, or text is rewritten")
        self.alone = m.piece_to_id(MARK)
        self.table = ChunkTable(self._encode, ENTRIES)

    def _encode(self, chunks: list[str]) -> list[tuple[list[int], str]]:
        """The library puts the first marker of a chunk before the text it is given."""
        ids = self.model.encode([c[1:] for c in chunks], num_threads=1)
        ids = [i if c != MARK else [self.alone] for c, i in zip(chunks, ids)]
        return [(i, ",".join(map(str, i))) for i in ids]

    def __call__(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """(ids, ids joined by commas) of each text."""
        split = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        get = self.table.fill(split)
        out = []
        for s in split:
            found = [get(c) for c in s]
            out.append((list(chain.from_iterable(f[0] for f in found)), ",".join([f[1] for f in found])))
        return out


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """id_col, ids, n_tokens, ids_sha256, decoded, decoded_sha256 for every row.

    A null or empty text has no ids and decodes to an empty text; rows with a null or repeated id, and repeated rows, are
    encoded one by one; other columns are not read; an empty table gives no rows. ``keep=False`` leaves out ids and text.
    """
    def work(batch: pa.RecordBatch):
        pieces = kept(Pieces, path)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, z in runs(texts):
            coded = pieces(texts[a:z])
            decoded = [pieces.model.decode(i) if i else "" for i, _ in coded]
            cols = [
                batch.column(0).slice(a, z - a),
                pa.array([len(i) for i, _ in coded], pa.int64()),
                pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in coded]),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
            ]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                cols += [pa.array([i for i, _ in coded], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_batch(docs.select(id_col, text_col), work, schema + (", ids array<int>, decoded string" if keep else ""))
