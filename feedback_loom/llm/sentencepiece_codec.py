"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

A byte-pair segmentation is the one sequence of pieces in which every two neighbours are
stable: encoding the two alone gives the two again. So it is a path over states, a state
being the piece that covers a position, with weight 0 between stable neighbours and
minus infinity otherwise. A chunk of a giant document turns into a matrix: rows are the
pieces that may cover its left boundary, columns those that may cover its right one, and an entry is the
weight of the best path between them. Matrices combine associatively in the max-plus
algebra, so products of neighbours are taken in a tree over many tasks; the piece at every boundary
is handed down that tree, and then every chunk is traced on its own, between its two boundary pieces.

Pieces with the blank mark inside, or with characters that only occur as single pieces, do
not exist in the usual vocabularies; where that holds, no piece crosses such a place, paths
meet there, and the text between two of them is encoded once and remembered. Whether it holds is
read from the vocabulary; if it does not, a chunk is one stretch.

Ids equal those of the SentencePiece library on the whole text. The one thing a decoded text loses
is the difference between a blank and the blank mark U+2581 itself.
"""

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import to_table
from .columns import mapped, quoted, without

MARK = "▁"
#: Characters from which on a document is cut into chunks, and of a chunk.
GIANT, CHUNK = 1 << 15, 1 << 14
#: Neighbouring matrices that one task combines.
FAN = 64
CACHE = 150_000


class Codec:
    """A byte-pair model file with what the scan needs to know of it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        self.pieces = {self.model.id_to_piece(i) for i in plain}
        self.longest = max(map(len, self.pieces))
        self.bytes = []
        for i in range(n):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else
                              b"" if self.model.is_control(i) else b" \xe2\x81\x87 " if self.model.is_unknown(i)
                              else piece.replace(MARK, " ").encode())
        apart = all(MARK not in p.lstrip(MARK) for p in self.pieces)
        feed = all("\n" not in p for p in self.pieces)
        # what no piece crosses: the place before a blank that follows something else, and both sides of a line feed
        self.stretches = re.compile(r" *[^ \n]+| +|\n" if apart and feed else r" *[^ ]+| +" if apart else r"(?s).+")
        self.feed_alone = feed
        self.lead = len(self.model.encode("\n"))
        self.known: dict[str, bytes] = {}
        self.stable_pairs: dict[tuple[str, str], bool] = {}

    def _encode_stretches(self, wanted: list[str]) -> None:
        """Remember the ids of stretches.

        A leading blank is the one that the model puts before a text; other stretches, and blanks alone, which the
        model would not see, are encoded behind a line feed, whose ids are dropped.
        """
        own = [s[0] == " " and bool(s.strip(" ")) for s in wanted]
        given = [s[1:] if o else "\n" + s for s, o in zip(wanted, own)]
        drop = [0 if o else self.lead for o in own]
        for stretch, ids, n in zip(wanted, self.model.encode(given, num_threads=1), drop):
            self.known[stretch] = np.array(ids[n:], np.int32).tobytes()

    def stretch_ids(self, text: str) -> np.ndarray:
        """Ids of a text whose first blank, if any, is already there."""
        text = text.replace(MARK, " ")
        stretches = self.stretches.findall(text)
        missing = [s for s in set(stretches) if s not in self.known]
        if missing:
            if len(self.known) + len(missing) > CACHE:
                self.known.clear()
                missing = list(set(stretches))
            self._encode_stretches(missing)
        return np.frombuffer(b"".join([self.known[s] for s in stretches]), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.stretch_ids(" " + text) if text else np.zeros(0, np.int32)

    def decode(self, ids) -> str:
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def stable(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay as they are; characters without a piece stand alone."""
        key = (left, right)
        if key not in self.stable_pairs:
            if len(self.stable_pairs) > CACHE:
                self.stable_pairs.clear()
            if left not in self.pieces or right not in self.pieces:
                self.stable_pairs[key] = True
            else:
                start = 2 if self.feed_alone else 0
                got = self.model.encode(("\n" if start else "") + left + right, out_type=str)
                self.stable_pairs[key] = got[start:] == [left, right] or (not start and got == [left, right])
        return self.stable_pairs[key]

    def covering(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces that begin before ``at`` and end there or behind it, in order; the start of the text is a state of its own."""
        if at <= 0:
            return [(0, 0)]
        found = []
        for begin in range(max(0, at - self.longest), at):
            for end in range(at, min(len(text), begin + self.longest) + 1):
                if text[begin:end] in self.pieces or end - begin == 1:
                    found.append((begin, end))
        return found

    def following(self, text: str, begin: int) -> list[int]:
        """Ends of the pieces that can begin at a place."""
        ends = [e for e in range(begin + 1, min(len(text), begin + self.longest) + 1)
                if e == begin + 1 or text[begin:e] in self.pieces]
        return ends

    def transfer(self, text: str, left: int, right: int) -> np.ndarray:
        """Weights of the best paths from each piece over ``left`` to each piece over ``right``.

        ``text`` has blanks as marks, and as many characters around the two places as pieces are long.
        """
        rows, columns = self.covering(text, left), self.covering(text, right)
        matrix = np.full((len(rows), len(columns)), -np.inf)
        column_of = {c: j for j, c in enumerate(columns)}
        # which rows reach a piece, as bits; places are worked off from left to right
        reach: dict[int, dict[int, int]] = {}
        for i, (begin, end) in enumerate(rows):
            ends = reach.setdefault(end, {})
            ends[begin] = ends.get(begin, 0) | 1 << i
        place = min(reach)
        while place < len(text) and reach:
            arrived = reach.pop(place, None)
            if arrived:
                for begin, bits in arrived.items():
                    if begin < right <= place and (begin, place) in column_of:
                        column = matrix[:, column_of[begin, place]]
                        for i in range(len(rows)):
                            if bits >> i & 1:
                                column[i] = 0.0
                if place < right:
                    for end in self.following(text, place):
                        piece, bits = text[place:end], 0
                        for begin, more in arrived.items():
                            if begin == place or self.stable(text[begin:place], piece):
                                bits |= more
                        if bits:
                            ends = reach.setdefault(end, {})
                            ends[place] = ends.get(place, 0) | bits
            place += 1
        for begin, bits in reach.get(place, {}).items():  # the end of the text
            if (begin, place) in column_of:
                for i in range(len(rows)):
                    if bits >> i & 1:
                        matrix[i, column_of[begin, place]] = 0.0
        return matrix

    def meeting(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """The first and last place within a range that no piece crosses, if pieces keep to stretches."""
        if not self.feed_alone:
            return None
        places = re.compile(rf"(?<=[^{MARK}])(?={MARK})|(?<=\n)|(?=\n)")
        first = places.search(text, low, high)
        if not first or first.start() >= high:
            return None
        last, step = first.start(), 64
        while True:
            found = [m.start() for m in places.finditer(text, max(low, high - step), high) if m.start() > low]
            if found:
                return first.start(), found[-1]
            if high - step <= low:
                return first.start(), last
            step *= 4


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices."""
    return (a[:, :, None] + b[None]).max(axis=1)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def chunk_matrix(own: Codec, text: str, left: int, right: int) -> np.ndarray:
    """Transfer matrix of a chunk ``[left, right)`` of a text with some context; paths that meet are followed only outside."""
    met = own.meeting(text, left + own.longest, right - own.longest) if right - left > 4 * own.longest else None
    if met is None:
        return own.transfer(text, left, right)
    first, last = met
    to_first = own.transfer(text[:first], left, first).max(axis=1)
    from_last = own.transfer(text[last:], 0, right - last).max(axis=0)
    return to_first[:, None] + from_last[None]


def combined(matrices: list[np.ndarray]) -> np.ndarray:
    """Product of neighbouring matrices, taken by halves."""
    if len(matrices) == 1:
        return matrices[0]
    middle = len(matrices) // 2
    return product(combined(matrices[:middle]), combined(matrices[middle:]))


def boundary_pieces(matrices: list[np.ndarray], enter: int | None = None, leave: int | None = None) -> list[int]:
    """The state behind each matrix on the best path over all of them, from one state and to one state where they are given."""
    def only(state: int | None, n: int) -> np.ndarray:
        return np.zeros(n) if state is None else np.where(np.arange(n) == state, 0.0, -np.inf)

    behind = [only(leave, matrices[-1].shape[1])]
    for matrix in reversed(matrices[1:]):
        behind.append((matrix + behind[-1]).max(axis=1))
    ahead, found = only(enter, matrices[0].shape[0]), []
    for matrix, rest in zip(matrices, reversed(behind)):
        arrived = (ahead[:, None] + matrix).max(axis=0)
        found.append(int((arrived + rest).argmax()))
        ahead = only(found[-1], len(rest))
    return found


def _matrices(rows: list[dict]) -> list[np.ndarray]:
    return [np.array(r["weights"]).reshape(r["n"], -1) for r in rows]


def _boundary_states(leaves: DataFrame, fan: int) -> DataFrame:
    """``(uid, chunk, enter, leave)``: the states on both sides of each chunk.

    ``fan`` neighbouring matrices are combined in a task, their products by further rounds, until
    one group per document is left; states are then handed down the same tree. So no task ever holds more than
    ``fan`` matrices, however long a document is.
    """
    node, states = "uid long, chunk int, n int, weights array<double>", "uid long, chunk int, enter int, leave int"
    node_schema, state_schema = (to_arrow_schema(T.StructType.fromDDL(s)) for s in (node, states))

    def up(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        whole = combined(_matrices(rows))
        return pa.Table.from_pylist([{"uid": rows[0]["uid"], "chunk": rows[0]["above"], "n": len(whole),
                                      "weights": whole.ravel().tolist()}], schema=node_schema)

    def down(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        found = boundary_pieces(_matrices(rows), rows[0]["enter"], rows[0]["leave"])
        enters = [rows[0]["enter"] or 0, *found[:-1]]  # a document begins in its only first state
        return pa.Table.from_pylist([{"uid": r["uid"], "chunk": r["chunk"], "enter": e, "leave": l}
                                     for r, e, l in zip(rows, enters, found)], schema=state_schema)

    def under(level: DataFrame) -> DataFrame:
        return level.select("uid", "chunk", "n", "weights", F.floor(F.col("chunk") / fan).cast("int").alias("above"))

    levels = [leaves.select("uid", "chunk", "n", "weights")]
    while not levels[-1].where(F.col("chunk") >= fan).isEmpty():
        levels.append(to_table(under(levels[-1]).groupBy("uid", "above").applyInArrow(up, node), "products"))
    given = None
    for level in reversed(levels):
        rows = under(level)
        if given is None:
            rows = rows.withColumn("enter", F.lit(None).cast("int")).withColumn("leave", F.lit(None).cast("int"))
        else:
            rows = rows.join(given.withColumnRenamed("chunk", "above"), ["uid", "above"])
        given = to_table(rows.groupBy("uid", "above").applyInArrow(down, states), "states")
    return given


def _id_lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", giant: int = GIANT, chunk: int = CHUNK,
            fan: int = FAN) -> DataFrame:
    """All rows and columns of ``docs`` with the piece ids of the whole text.

    A null text gives null, an empty one no ids. ``path`` is a byte-pair model file, readable on every
    executor. Documents of ``giant`` characters or more are spread as chunks of
    ``chunk`` characters, whose matrices are combined ``fan`` at a time. Columns named like ``ids``, ``_uid`` and
    ``_given`` give way.
    """
    docs = without(docs, ids, "_uid", "_given")
    given = docs.select("*", F.col(text).cast("string").alias("_given"))
    plain = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def small(batches):
        own = codec(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found = _id_lists([own.encode(v.as_py() or "") for v in column])
            if column.null_count:
                found = pa.ListArray.from_arrays(found.offsets, found.values, mask=column.is_null())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=plain.names)

    is_giant = F.coalesce(F.char_length("_given") >= giant, F.lit(False))
    done = mapped(given.where(~is_giant), small, plain)
    large = to_table(given.where(is_giant).select(F.monotonically_increasing_id().alias("_uid"), "*"), "giants")
    return done.unionByName(_encoded_giants(large, docs.columns, path, ids, chunk, fan))


def _encoded_giants(large: DataFrame, columns: list[str], path: str, ids: str, chunk: int, fan: int) -> DataFrame:
    def cut_up(batches):
        own = codec(path)
        for batch in batches:
            for uid, value in zip(batch.column(0), batch.column(1)):
                text = (" " + value.as_py()).replace(" ", MARK)
                for number, left in enumerate(range(0, len(text), chunk)):
                    right = min(len(text), left + chunk)
                    low, high = max(0, left - 2 * own.longest), min(len(text), right + 2 * own.longest)
                    yield pa.RecordBatch.from_pydict(
                        {"uid": [uid.as_py()], "chunk": [number], "left": [left - low], "right": [right - low],
                         "part": [text[low:high]]}, schema=cut_schema)

    cut_schema = to_arrow_schema(T.StructType.fromDDL("uid long, chunk int, left int, right int, part string"))
    chunks = large.select("_uid", "_given").mapInArrow(cut_up, "uid long, chunk int, left int, right int, part string")
    chunks = to_table(chunks.repartition("uid", "chunk"), "chunks")

    def matrices(batches):
        own = codec(path)
        for batch in batches:
            found = []
            for left, right, part in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                matrix = chunk_matrix(own, part, left, right)
                ends = [[b - left, e - left] for b, e in own.covering(part, left)], [[b - left, e - left] for b, e in own.covering(part, right)]
                found.append((matrix.shape[0], matrix.ravel().tolist(), [e for _, e in ends[0]], [e for _, e in ends[1]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([f[i] for f in found], t) for i, t in enumerate(
                    (pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()))))],
                names=["uid", "chunk", "n", "weights", "starts", "ends"])

    schema = "uid long, chunk int, n int, weights array<double>, starts array<int>, ends array<int>"
    spread = chunks.select("uid", "chunk", "left", "right", "part").mapInArrow(matrices, schema)

    leaves = to_table(spread, "matrices")
    # a chunk's own pieces begin where the piece over its left boundary ends and stop where the one over its right boundary does
    traces = (leaves.join(_boundary_states(leaves, fan), ["uid", "chunk"])
              .select("uid", "chunk", F.col("starts")[F.col("enter")].alias("begin"), F.col("ends")[F.col("leave")].alias("stop")))

    def backtraced(batches):
        own = codec(path)
        for batch in batches:
            found = [own.stretch_ids(part[left + begin:left + stop].replace(MARK, " ")) if stop > begin else np.zeros(0, np.int32)
                     for left, part, begin, stop in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _id_lists(found)], names=["uid", "chunk", "ids"])

    pieces = (chunks.join(traces, ["uid", "chunk"]).select("uid", "chunk", "left", "part", "begin", "stop")
              .mapInArrow(backtraced, "uid long, chunk int, ids array<int>"))
    whole = pieces.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("all"))
    whole = whole.select(F.col("uid").alias("_uid"), F.flatten(F.col("all.ids")).alias(ids))
    return large.join(whole, "_uid").select(*[quoted(c) for c in columns], ids)


def decoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns of ``docs`` with the text of ``ids``; null ids give null.

    Bytes that are no UTF-8 become U+FFFD. A column named like ``text`` gives way.
    """
    docs = without(docs, text)
    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())])
    at = docs.columns.index(ids)

    def run(batches):
        own = codec(path)
        for batch in batches:
            values = batch.column(at)
            found = [own.decode(v.values.to_numpy().tolist()) if v.is_valid else None for v in values]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=schema.names)

    return mapped(docs, run, schema)
