"""N-best segmentation over a SentencePiece piece lattice, and its decoding.

Nodes of the lattice are the places between characters, edges are the pieces of the model that
match there. Forward Viterbi gives for each node the best score from the start; a search from
the end back to the start uses that score as heuristic, which is exact, so that A* completes the
hypotheses in order of their full score.

Pieces hold a space at their start only (or nothing but spaces), and none holds a line break. So
the lattice of a text has a cut node at the start of each run of spaces and beside each line
break, through which every path runs. The search works on the parts between the cut nodes, once
for each different part: the best path of the text joins the best paths of its parts. Any of the
n best paths differs from the best one in the n - 1 parts with the smallest loss of their second
best path only, so just these are searched further; that is exact as well.

Characters without a piece become byte pieces. Decoding gives back every text exactly, also
spaces at the ends and the space mark itself in the text.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import lists, map_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4

SPACE_MARK = "▁"
# Scores below this mark pieces that are in the model for the sake of its ids only.
LEAST_SCORE = -1e8
# Score of a character without a piece, below the least score, as in the public library.
UNKNOWN_PENALTY = 10.0
# Parts held in a worker's memory, in two generations of half as many, and the longest of them; others are
# searched anew.
CACHED_PARTS = 450_000
CACHED_LENGTH = 64

PARTS = re.compile(r"\n| *[^ \n]+| +")


class Firsts(dict):
    """Best paths by part, found on demand; parts that end in a sign go by the part before it.

    When the younger generation is full, it becomes the older one, whose parts are forgotten unless
    they have come up again meanwhile.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.older: dict[str, tuple[bytes, float, float]] = {}

    def __missing__(self, part: str) -> tuple[bytes, float, float]:
        held = self.older.get(part)
        if held is None:
            held = self._found(part)
        if len(part) <= CACHED_LENGTH:
            if len(self) >= CACHED_PARTS // 2:
                self.older = dict(self)
                self.clear()
            self[part] = held
        return held

    def _found(self, part: str) -> tuple[bytes, float, float]:
        pairs, stop = self.pieces.pairs, len(part)
        if stop > 2 and part[-2:] not in pairs:  # a cut node: no piece crosses it
            stop -= 1
            while stop > 2 and part[stop - 2 : stop] not in pairs:
                stop -= 1
            own, score, least = self[part[:stop]]
            ids = [own]
            for sign in part[stop:]:
                own, more, loss = self[sign]
                ids.append(own)
                score += more
                if loss < least:
                    least = loss
            return b"".join(ids), score, least
        return self.pieces.first(part)


@dataclass
class Pieces:
    """Vocabulary of a model; spaces stand for themselves."""

    of_text: dict[str, tuple[int, float, bytes]]
    byte_ids: list[int]
    raw: list[bytes]
    longest: int
    unknown: float
    pairs: set[str]
    best: Firsts = field(init=False)
    paths: dict[str, list] = field(default_factory=dict)
    signs: set[str] = field(init=False)  # those with a piece of their own
    matches: ahocorasick.Automaton = field(init=False)  # signs before the last one, score, id

    def __post_init__(self) -> None:
        self.best = Firsts(self)
        self.signs = {t for t in self.of_text if len(t) == 1}
        self.matches = ahocorasick.Automaton()
        for text, (_, score, own) in self.of_text.items():
            self.matches.add_word(text, (len(text) - 1, score, own))
        self.matches.make_automaton()

    @staticmethod
    def load(model: bytes) -> Pieces:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        of_text, raw, bytes_at = {}, [], {}
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                bytes_at[int(piece[1:-1], 16)] = i
                raw.append(bytes([int(piece[1:-1], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                raw.append(b"")
            else:
                text = piece.replace(SPACE_MARK, " ")
                of_text[text] = (i, processor.get_score(i), np.int32(i).tobytes())
                raw.append(text.encode())
        if len(bytes_at) != 256:
            raise ValueError("the model has no byte pieces, so not every text could be encoded")
        crossing = [t for t in of_text if "\n" in t or (t.strip(" ") and " " in t.lstrip(" "))]
        if crossing:
            raise ValueError(f"pieces cross a space or a line break, such as {crossing[0]!r}")
        least = min(s for _, s, _ in of_text.values() if s > LEAST_SCORE)
        return Pieces(
            of_text,
            [bytes_at[b] for b in range(256)],
            raw,
            max(map(len, of_text)),
            least - UNKNOWN_PENALTY,
            {t[k : k + 2] for t in of_text for k in range(len(t) - 1)},
        )

    # --- the lattice of one part ---

    def edges(self, part: str) -> tuple[list[float], list[list[tuple[int, float, tuple[int, ...]]]]]:
        """Best score up to each node and the edges into it: (from, score, ids)."""
        get, longest, n = self.of_text.get, self.longest, len(part)
        forward, into = [0.0] * (n + 1), [[]]
        for end in range(1, n + 1):
            own, best = [], None
            for start in range(max(0, end - longest), end):
                found = get(part[start:end])
                if found is not None:
                    own.append((start, found[1], (found[0],)))
                    total = forward[start] + found[1]
                    if best is None or total > best:
                        best = total
            if not own or own[-1][0] != end - 1:  # no piece for this character alone
                ids = tuple(self.byte_ids[b] for b in part[end - 1].encode())
                own.append((end - 1, self.unknown, ids))
                total = forward[end - 1] + self.unknown
                if best is None or total > best:
                    best = total
            forward[end] = best
            into.append(own)
        return forward, into

    def search(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths, best first: backward A* with the forward scores as heuristic."""
        forward, into = self.edges(part)
        order, taken = 0, [0] * (len(part) + 1)
        open_paths = [(-forward[-1], 0, len(part), 0.0, None)]
        found = []
        while open_paths and len(found) < n:
            _, _, node, behind, path = heapq.heappop(open_paths)
            if node == 0:
                ids = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                found.append((behind, tuple(ids)))
                continue
            taken[node] += 1
            if taken[node] > n:  # n paths through this node are at least as good
                continue
            for start, score, own in into[node]:
                order += 1  # ties go by the order of expansion, the same in every run
                total = behind + score
                heapq.heappush(open_paths, (-(forward[start] + total), order, start, total, (own, path)))
        return found

    def first(self, part: str) -> tuple[bytes, float, float]:
        """Ids and score of the best path, and what the second best loses against it.

        The best path that is not expanded yet leaves the best one at some node, by that node's
        second best edge; so the smallest such loss on the way back is the second best's.
        """
        n = len(part)
        best, second = [-inf] * (n + 1), [-inf] * (n + 1)
        back, came = [0] * (n + 1), [b""] * (n + 1)
        best[0] = 0.0
        # edges by their last sign, longest first: the best path to where they start is known by then
        known = self.signs.issuperset(part)
        for end, (before, score, own) in self.matches.iter(part) if known else self._with_unknown(part):
            start = end - before
            end += 1
            total = best[start] + score
            if total > best[end]:
                second[end] = best[end]
                best[end], back[end], came[end] = total, start, own
            elif total > second[end]:
                second[end] = total
        ids, least, node = [], inf, n
        while node:
            less = best[node] - second[node]
            if less < least:
                least = less
            ids.append(came[node])
            node = back[node]
        ids.reverse()
        return b"".join(ids), best[n], least

    def _with_unknown(self, part: str):
        """Edges like ``matches`` gives them, and those of signs without a piece."""
        _, into = self.edges(part)
        for end, edges in enumerate(into):
            for start, score, ids in edges:
                yield end - 1, (end - 1 - start, score, np.array(ids, np.int32).tobytes())

    def n_best(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        held = self.paths.get(part)
        if held is None or held[0] < n:
            held = (n, self.search(part, n))
            if len(part) <= CACHED_LENGTH:
                if len(self.paths) >= CACHED_PARTS // 20:
                    self.paths.clear()
                self.paths[part] = held
        return held[1][:n]

    # --- whole texts ---

    def encode(self, text: str, n: int = 1):
        """Ids of the best path, and for each of the n best its score and its edits.

        An edit replaces ``length`` ids from ``at`` on (as of the best path) by ``ids``.
        """
        if not text:
            return b"", [(0.0, [])]
        parts = PARTS.findall(" " + text)
        held = list(map(self.best.__getitem__, parts))
        own, scores, losses = zip(*held)
        ids, score = b"".join(own), sum(scores)
        if n == 1:
            return ids, [(score, [])]
        losses = np.array(losses)
        if len(losses) > n - 1:  # the smallest losses; of equal ones the first
            limit = np.partition(losses, n - 2)[n - 2]
            near = np.flatnonzero(losses < limit)
            near = np.sort(np.append(near, np.flatnonzero(losses == limit)[: n - 1 - len(near)]))
        else:
            near = np.arange(len(losses))
        near = [int(i) for i in near if np.isfinite(losses[i])]
        joint: list[tuple[float, tuple]] = [(0.0, ())]
        for i in near:
            paths = self.n_best(parts[i], n)
            best = paths[0][0]
            joint = sorted(
                (loss + best - s, (*chosen, (i, k)) if k else chosen)
                for loss, chosen in joint
                for k, (s, _) in enumerate(paths)
            )[:n]
        starts = {}
        if near:
            ends = list(accumulate(map(len, own[: near[-1] + 1])))
            starts = {i: (ends[i] - len(own[i])) // 4 for i in near}
        found = []
        for loss, chosen in joint:
            edits = [
                (starts[i], len(held[i][0]) // 4, self.n_best(parts[i], n)[k][1]) for i, k in chosen
            ]
            found.append((score - loss, edits))
        return ids, found

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]


def apply_edits(ids: list[int], edits: list[tuple[int, int, tuple[int, ...]]]) -> list[int]:
    out, at = [], 0
    for start, length, new in edits:
        out += [*ids[at:start], *new]
        at = start + length
    return out + list(ids[at:])


@lru_cache(maxsize=2)
def _loaded(model: bytes) -> Pieces:
    return Pieces.load(model)


SCHEMA = (
    "piece_ids array<int>, n_pieces int, n_best array<struct<score: double, "
    "edits: array<struct<at: int, length: int, ids: array<int>>>>>, decoded_ok boolean"
)
_EDIT = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
_PATHS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))]))
_ROWS = 500


def _encode(model, n: int):
    def run(batch: pa.RecordBatch):
        pieces = _loaded(model.value)
        raw = pieces.raw
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            ids, paths, same = [], [], []
            for text in part.column(0).to_pylist():
                if text is None:
                    ids.append(None)
                    paths.append(None)
                    same.append(None)
                    continue
                own, found = pieces.encode(text, n)
                ids.append(own)
                listed = np.frombuffer(own, np.int32).tolist()
                whole = b"".join(map(raw.__getitem__, listed))
                good = whole[1:] == text.encode()
                out = []
                for score, edits in found:
                    for start, length, new in edits:
                        old = b"".join([raw[i] for i in listed[start : start + length]])
                        good = good and old == b"".join([raw[i] for i in new])
                    out.append(
                        {
                            "score": score,
                            "edits": [{"at": a, "length": k, "ids": list(new)} for a, k, new in edits],
                        }
                    )
                paths.append(out)
                same.append(good)
            counts = np.array([len(i) // 4 if i is not None else 0 for i in ids], np.int64)
            flat = pa.array(np.frombuffer(b"".join([i for i in ids if i]), np.int32))
            missing = pa.array([i is None for i in ids])
            listed = lists(flat, counts)
            if any(i is None for i in ids):
                listed = pa.ListArray.from_arrays(listed.offsets, listed.values, mask=missing)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in range(1, part.num_columns)],
                    listed,
                    pa.array([None if i is None else len(i) // 4 for i in ids], pa.int32()),
                    pa.array(paths, _PATHS),
                    pa.array(same, pa.bool_()),
                ],
                [*part.schema.names[1:], "piece_ids", "n_pieces", "n_best", "decoded_ok"],
            )

    return run


def encode_texts(
    docs: DataFrame,
    text_col: str = "text",
    model_path: str = MODEL,
    n: int = N_BEST,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with their segmentation; columns of the same names are replaced.

    * ``piece_ids``, ``n_pieces``: the best path; none for an empty text, null for a null text;
    * ``n_best``: up to ``n`` different paths, best first, each with its score and its edits of
      the best path. Paths of equal score come in a fixed order;
    * ``decoded_ok``: decoding the best path, and each edit, gives the text back exactly.

    Each row is worked on alone: no shuffle. The model file is read where the driver runs; it
    has a few hundred kilobytes whatever the input, and goes to the executors as a broadcast.
    ``carry`` names the columns to keep (all if None).
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    new = ("piece_ids", "n_pieces", "n_best", "decoded_ok")
    own = [c for c in (docs.columns if carry is None else carry) if c.lower() not in new]
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*own).schema
    )
    table = docs.select(docs[text_col].alias("_text"), *own)
    return map_arrow(table, _encode(model, n), f"{fields}, {SCHEMA}" if fields else SCHEMA)


def decode_pieces(
    table: DataFrame, ids_col: str = "piece_ids", model_path: str = MODEL, out_col: str = "decoded"
) -> DataFrame:
    """The rows of ``table`` with the text of an array of ids; null for null."""
    with open(model_path, "rb") as file:
        model = table.sparkSession.sparkContext.broadcast(file.read())
    own = [c for c in table.columns if c.lower() != out_col.lower()]

    def run(batch: pa.RecordBatch):
        pieces = _loaded(model.value)
        texts = [None if i is None else pieces.decode(i) for i in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in range(1, batch.num_columns)], pa.array(texts, pa.string())],
            [*batch.schema.names[1:], out_col],
        )

    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*own).schema
    )
    source = table.select(table[ids_col].alias("_ids"), *own)
    return map_arrow(source, run, f"{fields}, `{out_col}` string")
