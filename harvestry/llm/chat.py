"""Chat formatting: a hidden Markov model over a conversation's lines recovers who speaks, and turns are rendered in one canonical form.

States are the roles. A line emits features: the speaker marker at its start, if any, and its length, ending and look; a row's first line also
emits the row's length and number of lines, and, if the row stands alone, its turn number. A role's chances of each feature, to open a conversation, and to follow another role in the next row are counted over all
rows by their given role (add-one smoothing); markers, and staying in a role within a row, have fixed chances. Viterbi picks the likeliest roles of
all lines of a conversation, whose rows are ordered by turn (null first), then by a hash of the text; neighbouring lines of a role in a row make a
turn. The given role serves to count only, never to decide.

A conversation may hold any share of all rows: rows are split by ranges of (conv_id, turn), and runs of a conversation are packed into chunks of
bounded size. A chunk of a conversation with several is reduced to a max-plus matrix of entry by end state; the matrices of a conversation are
combined, and each chunk is decoded between its known states. Text crosses the network once. Small tables of such chunks are broadcast: there are at
most two for each chunk's worth of rows and each range.

Defined results: a null or empty text has no turns and renders to ''. Rows that agree in id, turn and text are one place in the conversation and get
equal results. A null id is a conversation of that row alone. Null turns and roles are kept as they are; unknown roles are not counted. Other columns
are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import stored

ROLES = ("system", "user", "assistant", "tool")
MOST_FEATURES = 64
#: A chunk is closed when it holds this many places or characters.
CHUNK_TURNS, CHUNK_CHARS = 4096, 1 << 20
#: Chances that the next line stays in its role, without and after a marker; and that a marker tells the truth.
STAY, TRUE_MARK = 0.97, 0.995
WITHIN = np.where(np.eye(len(ROLES), dtype=bool), np.log(STAY), np.log((1 - STAY) / (len(ROLES) - 1)))
FREE = np.full((len(ROLES), len(ROLES)), -np.log(len(ROLES)))

# Words that name a speaker, and the forms in which they stand at the start of a line.
NAMES = {"system": "system", "user": "user", "human": "user", "question": "user", "q": "user", "customer": "user", "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
         "answer": "assistant", "a": "assistant", "agent": "assistant", "tool": "tool", "function": "tool", "observation": "tool"}
MARK = re.compile(r"^\s*(?:<\|(?:im_start\|>)?\s*(?P<x>\w+)\s*(?:\|>)?|#{1,4}\s*(?P<y>\w+)\s*:?\s*$|[\[*]*(?P<z>\w+)[\]*]*\s*:[\]*]*)\s*(?P<rest>.*)$", re.S)
END = re.compile(r"<\|(?:im_end|end|eot_id)\|>\s*$")


def marker(line: str) -> tuple[str | None, str]:
    """The role that a line's start names, and the line without it."""
    m = MARK.match(line)
    role = NAMES.get((m["x"] or m["y"] or m["z"]).lower()) if m else None
    return (role, END.sub("", m["rest"])) if role else (None, END.sub("", line))


def features(line: str, turn: int | None, first: bool) -> list[str]:
    text = line.strip()
    out = [f"length{min(8, len(text).bit_length())}", "asks" if text.endswith("?") else "ends" if text.endswith((".", "!")) else "open"]
    out += ["code"] if text.startswith(("```", "{", "[", "    ")) else []
    out += ["orders"] if re.match(r"(?i)you are |always |never ", text) else []
    return out + ([f"turn{'-' if turn is None else turn if turn < 3 else 3 + turn % 2}"] if first else [])


def of_row(text: str) -> list[str]:
    """Features of a whole row, which its first line emits."""
    return [f"chars{min(20, max(0, int(2 * np.log2(len(text) + 1)) - 6))}", f"lines{min(9, text.strip().count(chr(10)))}"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for turn, role, text in zip(*(batch.column(k).to_pylist() for k in ("turn", "role", "text"))):
            for at, line in enumerate((text or "").split("\n") if role in ROLES else ()):
                if line.strip():
                    seen.update((role, f) for f in features(marker(line)[1], turn, at == 0))
            seen.update((role, f) for f in (of_row(text) if text and text.strip() and role in ROLES else ()))
        yield pa.record_batch([pa.array([r for r, _ in seen], pa.string()), pa.array([f for _, f in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["role", "feature", "n"])


def _lines(places: list[tuple], chances: dict[str, np.ndarray], alone: bool = False) -> Iterator[tuple]:
    """``(place, marker, line, ways in, emitted)`` of each line of ``(turn, text, ...)`` places. Only a row alone emits its turn number: elsewhere the ways in tell as much."""
    k = len(ROLES)
    between = chances.get("moves", FREE)
    for place, (turn, text, *_) in enumerate(places):
        for at, (mark, line) in enumerate(marker(x) for x in (text or "").split("\n")):
            own = features(line, turn, at == 0 and alone) if line.strip() else []
            emitted = sum((chances[f] for f in own + (of_row(text) if at == 0 and text and text.strip() else []) if f in chances), np.zeros(k))
            if mark:
                emitted = emitted + np.log(np.where(np.array(ROLES) == mark, TRUE_MARK, (1 - TRUE_MARK) / (k - 1)))
            yield place, mark, line, between if at == 0 else FREE if mark else WITHIN, emitted


def reduced(places: list[tuple], chances: dict[str, np.ndarray]) -> np.ndarray:
    """Best scores of a chunk's paths by (role before, role at its end); the last row is for a chunk that opens its conversation."""
    score = None
    for *_, ways, emitted in _lines(places, chances):
        score = (np.vstack([ways, chances.get("opens", np.zeros(len(ROLES)))]) if score is None else (score[:, :, None] + ways).max(axis=1)) + emitted
    return score


def decode(places: list[tuple], chances: dict[str, np.ndarray], opens: np.ndarray, leave: int | None = None, alone: bool = False) -> list[list[tuple[str, str]]]:
    """``(role, content)`` of each turn of each place; ``opens`` scores the first line's roles, ``leave`` is the last line's role if it is known."""
    lines, back, score = list(_lines(places, chances, alone)), [], np.zeros(len(ROLES))
    for at, (*_, ways, emitted) in enumerate(lines):
        if at:
            through = score[:, None] + ways
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + emitted
        else:
            score = opens + emitted
    path = [int(score.argmax()) if leave is None else leave]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    turns: list[list] = [[] for _ in places]
    for role, (place, mark, line, *_) in zip(reversed(path), lines):
        own = turns[place]
        if own and own[-1][0] == ROLES[role] and not mark:
            own[-1][1].append(line)
        else:
            own.append([ROLES[role], [line]])
    return [[(role, "\n".join(x).strip()) for role, x in own if "\n".join(x).strip()] for own in turns]


def viterbi(text: str | None, turn: int | None, chances: dict[str, np.ndarray]) -> list[tuple[str, str]]:
    """``(role, content)`` of each turn in a text that stands alone."""
    return decode([(turn, text)], chances, chances.get("start", np.zeros(len(ROLES))), alone=True)[0]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{content}\n<|end|>\n" for role, content in turns)


def _chunks(batches: Iterator[pa.RecordBatch], most_turns: int, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to chunks: places of one conversation as (turn, text, copies by role), the moves between given roles, and the outer roles."""
    part, press, chunk, size = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3), 0, 0
    conv, places = None, []

    def close() -> pa.RecordBatch:
        given = [max(sorted((r, n) for r, n in c.items() if r in ROLES), key=lambda x: x[1])[0] if any(r in ROLES for r in c) else None for *_, c in places]
        moves = np.zeros((len(ROLES), len(ROLES)), np.int64)
        for a, b in zip(given, given[1:]) if conv is not None else ():
            if a and b:
                moves[ROLES.index(a), ROLES.index(b)] += 1
        columns = [pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([chunk], pa.int64()), pa.array([given[0]], pa.string()), pa.array([given[-1]], pa.string()),
                   pa.array([moves.ravel().tolist()], pa.list_(pa.int64())), pa.array([press.compress(pickle.dumps(places))], pa.binary())]
        return pa.record_batch(columns, names=["conv_id", "part", "chunk", "first", "last", "moves", "packed"])

    for batch in batches:
        for own, turn, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
            if places and own == conv and places[-1][:2] == (turn, text):
                places[-1][2][role] += 1
                continue
            if places and (own != conv or len(places) >= most_turns or size >= most_chars):
                yield close()
                chunk, size, places = chunk + 1, 0, []
            conv = own
            places.append((turn, text, Counter({role: 1})))
            size += len(text or "")
    if places:
        yield close()


def _unpack(packed: bytes) -> list[tuple]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(packed))


def _reduce(batches: Iterator[pa.RecordBatch], chances: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [reduced(_unpack(p), chances).ravel().tolist() for p in batch.column("packed").to_pylist()]
        yield pa.record_batch([*(batch.column(k) for k in ("conv_id", "part", "chunk")), pa.array(found, pa.list_(pa.float64()))], names=["conv_id", "part", "chunk", "matrix"])


def _combine(group: pa.Table) -> pa.Table:
    """The role before each chunk of a conversation (-1: none), the role at its end, and its number."""
    group = group.sort_by([("part", "ascending"), ("chunk", "ascending")])
    k = len(ROLES)
    matrices = [np.array(m).reshape(k + 1, k) for m in group.column("matrix").to_pylist()]
    score, back = matrices[0][k], []
    for m in matrices[1:]:
        through = score[:, None] + m[:k]
        back.append(through.argmax(axis=0))
        score = through.max(axis=0)
    ends = [int(score.argmax())]
    for step in reversed(back):
        ends.append(int(step[ends[-1]]))
    ends.reverse()
    return pa.table([group.column("part"), group.column("chunk"), pa.array([-1, *ends[:-1]], pa.int32()), pa.array(ends, pa.int32()), pa.array(range(len(ends)), pa.int64())], names=["part", "chunk", "enter", "leave", "piece"])


def _decoded(batches: Iterator[pa.RecordBatch], chances: dict[str, np.ndarray]) -> Iterator[tuple]:
    """``(conv_id, piece, places, turns of each)`` of each chunk; places of null ids stand alone."""
    for batch in batches:
        for conv, packed, enter, leave, piece in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "packed", "enter", "leave", "piece"))):
            places = _unpack(packed)
            if conv is None:
                yield conv, 0, places, [viterbi(text, turn, chances) for turn, text, _ in places]
            else:
                opens = chances["opens"] if enter is None or enter < 0 else chances["moves"][enter]
                yield conv, piece or 0, places, decode(places, chances, opens, leave)


def _rows(batches: Iterator[pa.RecordBatch], chances: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), types)], names=["conv_id", "turn", "role", "roles", "n_turns", "rendered"])

    for conv, _, places, turns in _decoded(batches, chances):
        for (turn, _, copies), own in zip(places, turns):
            roles, text = ",".join(r for r, _ in own), render(own)
            for role, n in copies.items():
                for _ in range(n):
                    held.append((conv, turn, role, roles, len(own), text))
                    if len(held) >= 500:
                        yield batch()
                        held.clear()
    if held:
        yield batch()


def _whole(batches: Iterator[pa.RecordBatch], chances: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for conv, piece, places, turns in _decoded(batches, chances):
        if conv is None:
            found = [own for own, (*_, copies) in zip(turns, places) for _ in range(sum(copies.values()))]
        else:
            found = [[t for own in turns for t in own]]
        yield pa.record_batch([pa.array([conv] * len(found), pa.int64()), pa.array([piece] * len(found), pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array([render(f) for f in found], pa.string())],
                              names=["conv_id", "piece", "n_turns", "rendered"])


def _prepared(rows: DataFrame) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Chunks with the roles around them, and the learned chances."""
    k = len(ROLES)
    narrow = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    counted = narrow.mapInArrow(_count, "role string, feature string, n long").groupBy("role", "feature").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for role, feature, n in counted.collect():  # one row for each role and feature
        counts.setdefault(feature, np.ones(k))[ROLES.index(role)] += n
    of = lambda kind: sum((v for f, v in counts.items() if f.startswith(kind)), np.ones(k))
    lines, starts = of("length"), of("turn")
    chances = {f: np.log(v / (starts if f.startswith(("turn", "chars", "lines")) else lines)) for f, v in counts.items()} | {"start": np.log(starts / starts.sum())}
    dealt = narrow.withColumn("_h", F.xxhash64("text")).repartitionByRange("conv_id", "turn", "_h").sortWithinPartitions("conv_id", "turn", "_h", "text")
    limits = CHUNK_TURNS, CHUNK_CHARS
    chunks = stored(dealt.select("conv_id", "turn", "role", "text").mapInArrow(lambda b: _chunks(b, *limits), "conv_id long, part int, chunk long, first string, last string, moves array<long>, packed binary"), "chats")
    of_conv = Window.partitionBy("conv_id")
    meta = stored(chunks.where("conv_id is not null").select("conv_id", "part", "chunk", "first", F.lag(F.struct("last")).over(of_conv.orderBy("part", "chunk")).alias("before"), F.count("*").over(of_conv).alias("n")), "chat_runs")
    moves, opens = np.ones((k, k)), np.ones(k)
    inner = chunks.agg(*(F.sum(F.col("moves")[i]) for i in range(k * k))).first()
    moves += np.array([x or 0 for x in inner], float).reshape(k, k)
    for opened, before, first, n in meta.where(F.col("first").isNotNull()).groupBy(F.col("before").isNull(), F.col("before.last"), "first").count().collect():
        if opened:
            opens[ROLES.index(first)] += n
        elif before is not None:
            moves[ROLES.index(before), ROLES.index(first)] += n
    chances |= {"moves": np.log(moves / moves.sum(axis=1, keepdims=True)), "opens": np.log(opens / opens.sum())}
    split = chunks.join(F.broadcast(meta.where("n > 1").select("part", "chunk")), ["part", "chunk"])
    matrices = split.select("conv_id", "part", "chunk", "packed").mapInArrow(lambda b: _reduce(b, chances), "conv_id long, part int, chunk long, matrix array<double>")
    ends = stored(matrices.groupBy("conv_id").applyInArrow(_combine, "part int, chunk long, enter int, leave int, piece long"), "chat_ends")
    return chunks.join(F.broadcast(ends), ["part", "chunk"], "left").select("conv_id", "packed", "enter", "leave", "piece"), chances


def format_chats(rows: DataFrame) -> DataFrame:
    """Per row: ``conv_id, turn, role`` as given, the recovered ``roles``, how many turns, and the canonical text. Roles are those of the whole conversation's best path."""
    chunks, chances = _prepared(rows)
    return chunks.mapInArrow(lambda b: _rows(b, chances), "conv_id long, turn long, role string, roles string, n_turns long, rendered string")


def conversations(rows: DataFrame) -> DataFrame:
    """Whole conversations: ``conv_id, piece, n_turns, rendered``. One over a chunk's size comes in numbered pieces, whose texts follow each other."""
    chunks, chances = _prepared(rows)
    return chunks.mapInArrow(lambda b: _whole(b, chances), "conv_id long, piece long, n_turns long, rendered string")
