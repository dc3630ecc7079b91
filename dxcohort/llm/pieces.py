"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a node for each boundary between symbols (code
points after white space is escaped) and an edge for each vocabulary piece. The
search goes symbol by symbol and keeps, for each boundary of a window as long
as the longest piece, the edge of the best path that ends there. When the paths
of all boundaries that a later piece can start from run through one boundary,
the ids up to it are final: they are emitted and the window moves there.

* Unigram models: the best path has the highest sum of scores.
* BPE models: an edge may follow another only if merging their joined text
  by the model's priorities gives exactly these two pieces. A sequence of pieces
  is the BPE encoding of its text if and only if that holds for each adjacent
  pair, so one path survives at each boundary and the result is the library's.
  An automaton of the pieces' beginnings names the pieces that end at a boundary;
  the shortest, a single symbol, is what remains if no longer one may follow.

Where no piece goes on past a white space symbol, every word start is a
boundary on which all paths converge (so are both sides of a symbol that is in
no piece, such as a line end). The ids of such stretches are then kept
in a bounded table, so a word that comes again is not searched again; new words are searched in lexical
order, and the window's state after a common beginning serves all of them.

Decoding joins pieces, bytes and spaces through a table. Null and empty texts
have no ids. Repeated rows are encoded one by one; extra columns are carried
along by ``encode_documents``; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dxcohort.llm.common import CHUNK_BYTES, ship, worker_tables

SPACE = "▁"
#: Entries of each table of known stretches and pairs; a full one is replaced.
TABLE_ENTRIES = 600_000
#: Longer stretches are not kept.
KEEP_CHARS = 48
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6


class Pieces:
    """Vocabulary, scores and settings of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec = model.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave texts as they are (identity, all white space kept) can be encoded")
        if any(p.type == _USER for p in model.pieces):
            raise ValueError("user-defined symbols are not supported")
        self.bpe = model.trainer_spec.model_type == 2
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.scores = [p.score for p in model.pieces]
        self.score_of = {piece: self.scores[i] for piece, i in self.ids.items()}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        #: Every ending of a piece: its id if it is a piece itself, else -1.
        self.ends = {piece[i:]: -1 for piece in self.ids for i in range(len(piece))} | self.ids
        self.longest = max(map(len, self.ids), default=1)
        self.least = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.table = [
            bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(SPACE, " ").encode() if p.type == _NORMAL
            else " ⁇ ".encode() if p.type == _UNKNOWN else b""
            for p in model.pieces
        ]
        if self.bpe:  # pieces that merging never makes of their own text cannot occur
            for piece in self.ids:
                if len(self.merged(piece)) > 1:
                    self.ends[piece] = -1
            self._automaton()
        #: Whether some piece goes on past a white space symbol after another one.
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # Symbols that are in no piece stand alone: all paths meet before and after them.
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.stretch = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|[{alone}]" if alone else ""))

    def _automaton(self) -> None:
        """Nodes are beginnings of pieces (0: the empty one). ``step``: the node of a
        node (21 bits to the left) and a symbol; ``fail``: the longest other node that
        ends a node; ``out``: lengths and ids of the pieces of two symbols or more that
        end it, longest first."""
        self.step: dict[int, int] = {}
        parent, depth, symbol, whole = [0], [0], [0], {}
        for piece, i in self.ids.items():
            if self.ends[piece] < 0:
                continue
            node = 0
            for c in map(ord, piece):
                to = self.step.get(node << 21 | c)
                if to is None:
                    to = self.step[node << 21 | c] = len(parent)
                    parent.append(node)
                    depth.append(depth[node] + 1)
                    symbol.append(c)
                node = to
            if len(piece) > 1:
                whole[node] = ((len(piece), i),)
        self.fail = [0] * len(parent)
        self.out: list[tuple[tuple[int, int], ...]] = [()] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if depth[node] > 1:
                to = self.fail[parent[node]]
                while to and to << 21 | symbol[node] not in self.step:
                    to = self.fail[to]
                self.fail[node] = self.step.get(to << 21 | symbol[node], 0)
            self.out[node] = whole.get(node, ()) + self.out[self.fail[node]]

    def spell(self, symbol: str) -> list[int]:
        """Ids of a symbol without a piece."""
        return [self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")] if len(self.bytes) == 256 else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """BPE by definition: join the adjacent pair whose piece has the highest
        score, the leftmost of equals, until none is left. For short texts."""
        score, none = self.score_of.get, float("-inf")
        parts = list(text)
        joins = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while joins and (best := max(joins)) != none:
            i = joins.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joins[i]
            if i < len(joins):
                joins[i] = score(parts[i] + parts[i + 1], none)
            if i:
                joins[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts


class Encoder:
    """Streaming encoder; ``stream`` yields ids as they become final."""

    def __init__(self, pieces: Pieces, entries: int | None = None):
        self.p, self.entries = pieces, entries or TABLE_ENTRIES
        self.names = {i: piece for piece, i in pieces.ids.items()}
        self.size = max(self.names, default=0) + 1
        self.codes = [i.to_bytes(4, "little") for i in range(self.size)]
        self.pairs: dict[int | tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the table before: words in use move over

    def _may_follow(self, key: int | tuple[str, str], a: str, b: str) -> bool:
        if len(self.pairs) >= TABLE_ENTRIES:
            self.pairs.clear()
        got = self.pairs[key] = self.p.merged(a + b) == [a, b]
        return got

    def _begin(self) -> tuple[list[int], list[int], list]:
        """At boundary 0: where the best path's last edge begins, the id of its piece
        (-1: a symbol without one, -2: none), and a node (BPE) or a score."""
        return [0], [-2], [0 if self.p.bpe else 0.0]

    def _extend(self, text: str, done: int, edge: list[int], kind: list[int], state: list, before: str | None) -> None:
        """The best path's last edge for each boundary of ``text`` after ``done``."""
        (self._extend_bpe if self.p.bpe else self._extend_unigram)(text, done, edge, kind, state, before)

    def _extend_bpe(self, text: str, done: int, edge: list[int], kind: list[int], state: list[int], before: str | None) -> None:
        p, step, fail, out, pairs, size = self.p, self.p.step.get, self.p.fail, self.p.out, self.pairs.get, self.size
        node = state[done]
        for n, c in enumerate(text[done:], done + 1):
            symbol = ord(c)
            to = step(node << 21 | symbol)
            while to is None:
                if not node:
                    to = 0
                    break
                node = fail[node]
                to = step(node << 21 | symbol)
            node = to
            state.append(node)
            for length, k in out[node]:
                start = n - length
                if start < 0:
                    continue
                last = kind[start]
                if last >= 0:
                    ok = pairs(last * size + k)
                    if ok is None:
                        ok = self._may_follow(last * size + k, self.names[last], self.names[k])
                elif last == -2:
                    ok = True
                else:
                    a, b = text[edge[start] : start] if start else before, self.names[k]
                    ok = pairs((a, b))
                    if ok is None:
                        ok = self._may_follow((a, b), a, b)
                if ok:
                    edge.append(start)
                    kind.append(k)
                    break
            else:
                edge.append(n - 1)
                kind.append(p.ids.get(c, -1))

    def _extend_unigram(self, text: str, done: int, edge: list[int], kind: list[int], best: list[float], before: str | None) -> None:
        p, ends = self.p, self.p.ends.get
        for n in range(done + 1, len(text) + 1):
            found = []
            for start in range(n - 1, -1, -1):
                k = ends(text[start:n])
                if k is None:  # no piece ends like this
                    break
                if k >= 0:
                    found.append(start)
            choice, top = n - 1, None
            if not found or found[0] != n - 1:
                found.append(n - 1)  # a symbol without a piece
            for start in found:
                piece = text[start:n]
                score = best[start] + (p.score_of[piece] if piece in p.score_of else p.least)
                if top is None or score > top:
                    choice, top = start, score
            edge.append(choice)
            kind.append(p.ids.get(text[choice:n], -1))
            best.append(top)

    def stream(self, chunks: Iterator[str]) -> Iterator[int]:
        """Ids of a text that comes in parts of any size, as they become final."""
        longest = self.p.longest
        text = ""  # symbols from the last final boundary on
        edge, kind, state = self._begin()
        before: str | None = None  # the last final piece, which the next must be able to follow
        for chunk in chunks:
            for low in range(0, len(chunk), longest):
                done = len(text)
                text += chunk[low : low + longest]
                self._extend(text, done, edge, kind, state, before)
                if len(text) >= 2 * longest and (final := self._converged(edge, len(text), longest)):
                    yield from self._emit(text, edge, final)
                    before = text[edge[final] : final]
                    text = text[final:]
                    edge = [0] + [e - final for e in edge[final + 1 :]]
                    kind = kind[final:]
                    state = state[final:] if self.p.bpe else [b - state[final] for b in state[final:]]
        yield from self._emit(text, edge, len(text))

    @staticmethod
    def _converged(edge: list[int], n: int, longest: int) -> int:
        """The last boundary that the paths of all of the window's boundaries
        run through (0: none but the last final one)."""
        alive = set(range(n - longest + 1, n + 1))
        while len(alive) > 1:
            high = max(alive)
            alive.remove(high)
            alive.add(edge[high])
        return alive.pop()

    def _emit(self, text: str, edge: list[int], end: int) -> list[int]:
        out: list[list[int]] = []
        while end:
            piece = text[edge[end] : end]
            k = self.p.ids.get(piece)
            out.append([k] if k is not None else self.p.spell(piece))
            end = edge[end]
        return [i for part in reversed(out) for i in part]

    def _settle(self, stretches: list[str], known: dict[str, bytes]) -> None:
        """Search new stretches in lexical order, into ``known``: the window's
        state after a common beginning serves all that share it."""
        (edge, kind, state), last, codes = self._begin(), "", self.codes
        for s in sorted(stretches):
            same, most = 0, min(len(s), len(last))
            while same < most and s[same] == last[same]:
                same += 1
            del edge[same + 1 :], kind[same + 1 :], state[same + 1 :]
            self._extend(s, same, edge, kind, state, None)
            last, end, parts = s, len(s), []
            while end:
                parts.append(codes[kind[end]] if kind[end] >= 0 else np.array(self.p.spell(s[end - 1]), np.uint32).tobytes())
                end = edge[end]
            parts.reverse()
            known[s] = b"".join(parts)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (unsigned 32-bit little-endian)."""
        escaped = [self.p.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        if self.p.crossing:
            return [np.fromiter(self.stream([s]), np.uint32).tobytes() for s in escaped]
        split = [self.p.stretch.findall(s) for s in escaped]
        if len(self.known) >= self.entries:
            self.known, self.older = {}, self.known
        new = set().union(*split).difference(self.known)
        self.known.update((x, self.older[x]) for x in new if x in self.older)
        new = [x for x in new if x not in self.older]
        long = [x for x in new if len(x) > KEEP_CHARS]
        self.known.update((x, np.fromiter(self.stream([x]), np.uint32).tobytes()) for x in long)
        self._settle([x for x in new if len(x) <= KEEP_CHARS], self.known)
        coded = [b"".join(map(self.known.__getitem__, parts)) for parts in split]
        for x in long:
            del self.known[x]
        return coded

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        table = self.p.table
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.p.prefix and text[:1] == " " else text


def model_path() -> str:
    """The public 32k BPE vocabulary; every function takes another path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoder(path: str, entries: int | None = None) -> Encoder:
    """One encoder for each Python worker and model, so its table is kept."""
    held = worker_tables("pieces")
    if (path, entries) not in held:
        held[path, entries] = Encoder(Pieces(path), entries)
    return held[path, entries]


def _coded(batches: Iterator[pa.RecordBatch], e: Encoder) -> Iterator[tuple[pa.RecordBatch, list[str], list[bytes]]]:
    """Batches with a text column, in slices of about a megabyte, their texts
    (null: empty) and ids."""
    for batch in batches:
        texts, low, size = [], 0, 0
        for d, t in enumerate(batch.column(batch.schema.get_field_index("text"))):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_BYTES or d == batch.num_rows - 1:
                yield batch.slice(low, d + 1 - low), texts, e.encode_many(texts)
                texts, low, size = [], d + 1, 0


def encode_documents(docs: DataFrame, path: str | None = None, entries: int | None = None) -> DataFrame:
    """``docs`` without text, and with ids (array<int>), n_ids and ids_crc32.
    ``entries`` bounds the table of known words, where memory is short."""
    ship(docs.sparkSession)
    path = path or model_path()
    rest = [c for c in docs.columns if c not in ("text", "ids", "n_ids", "ids_crc32")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, coded in _coded(batches, encoder(path, entries)):
            off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])])
            out = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            out["ids"] = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))
            out["n_ids"] = pa.array(np.diff(off), pa.int64())
            out["ids_crc32"] = pa.array([zlib.crc32(x) for x in coded], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    fields = [f for f in docs.schema.fields if f.name in rest]
    schema = docs.select(*[f.name for f in fields]).schema.add("ids", T.ArrayType(T.IntegerType())).add("n_ids", "long").add("ids_crc32", "long")
    return docs.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op9_sentencepiece(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (unsigned, of 32-bit little-endian ids),
    n_decoded (code points of the decoded text) and round_trip: whether the ids
    decode to the text. (A text that holds U+2581 itself decodes to a space.)"""
    ship(docs.sparkSession)
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch, texts, coded in _coded(batches, e):
            n, crc, size, same = [], [], [], []
            for text, ids in zip(texts, coded, strict=True):
                back = e.decode(np.frombuffer(ids, np.uint32))
                n.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                size.append(len(back))
                same.append(back == text)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_ids": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "n_decoded": pa.array(size, pa.int64()), "round_trip": pa.array(same, pa.bool_()),
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, n_decoded long, round_trip boolean")
