"""Encoding and decoding with a SentencePiece merge model, by backtracking.

A merge model joins the best-scored adjacent pair until none is left. A
sequence of pieces is its result exactly if every adjacent pair of pieces stays
apart when the two are merged anew from their characters. So pieces are laid
left to right, the longest match first (Aho-Corasick); a pair that does not
stay apart falls back to the next shorter piece, and a position from which
nothing fits is struck out of a bitfield and never tried again.

Texts are cut before every run of space symbols and between two symbols that
stand side by side in no piece that merging can reach; no piece reaches over
such a cut, so parts are encoded on their own and remembered.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Sequence
from operator import add

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.remembered import Made
from streetlens.llm.tables import text_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
REMEMBER = 150_000  # words of a generation, and steps, in a Python worker
OUT_BYTES = 4 << 20


class MergeModel:
    """The pieces of a model file and what encoding needs of them; plain data that can be sent to the executors."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.kinds = [
            CONTROL if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else BYTE if sp.is_byte(i) else NORMAL
            for i in range(len(self.pieces))
        ]
        scores = [sp.get_score(i) for i in range(len(self.pieces))]
        self.score = {p: scores[i] for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        known = {c for p in self.score for c in p if c in self.score}
        # pieces that merging can reach, and where the last merge joins them (0: a symbol); worked out once for all tasks
        self.joint: dict[str, int] = {}
        others = dict(self.score)
        for p in filter(known.issuperset, self.score):
            score = others.pop(p)
            halves = merged(p, others)
            if len(halves) < 3:
                self.joint[p] = len(halves[0]) % len(p)
            others[p] = score
        if any(SPACE in p.lstrip(SPACE) for p, k in zip(self.pieces, self.kinds) if k == NORMAL):
            raise ValueError("a piece has a space symbol behind another symbol; parts cannot be encoded on their own")
        if sum(k == BYTE for k in self.kinds) != 256:
            raise ValueError("the model has no byte pieces")


def merged(text: str, score: dict[str, float]) -> list[str]:
    """The merge process itself: join the best pair, the leftmost of equals, until none is left."""
    parts: list[str | None] = list(text)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            s = score.get(parts[i] + parts[j])
            if s is not None:
                heapq.heappush(heap, (-s, i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, j, both = heapq.heappop(heap)
        if parts[i] is None or j >= len(parts) or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
            continue
        parts[i], parts[j] = both, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


class Encoder:
    """Encodes and decodes texts; remembers parts and pairs in bounded tables."""

    def __init__(self, model: MergeModel):
        self.model = model
        self.score, self.joint = model.score, model.joint
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.packed = {p: i.to_bytes(4, "little") for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        self.machine = ahocorasick.Automaton()
        for p in model.joint:
            self.machine.add_word(p, p)
        self.machine.make_automaton()
        self.beside = {p[i : i + 2] for p in model.joint for i in range(len(p) - 1)}  # symbols that some piece holds side by side
        best = sorted((p for p in self.score if p.strip(SPACE) or len(p) == 1), key=self.score.__getitem__, reverse=True)
        self.rank = {p: n for n, p in enumerate(best)}  # in the order of merging
        self.ties = len({self.score[p] for p in best if len(p) > 1}) < sum(len(p) > 1 for p in best)
        self.shorter: dict[str, str] = {}
        self.steps: dict[str, dict[str, str]] = {}  # by last piece and longest match, the piece to lay
        self.n_steps = 0
        self.parts = Made(REMEMBER, self._behind_space)  # of words behind a space symbol
        self.starts = Made(REMEMBER // 8, self._part)  # of words at the start of a line, and of what follows a cut
        self.line = None if "\n" in self.packed else self.byte[10].to_bytes(4, "little")
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*")
        self.surface = [
            b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE
            else p.replace(SPACE, " ").encode()
            for p, k in zip(model.pieces, model.kinds)
        ]

    def _next_shorter(self, piece: str) -> str:
        """The longest piece that is a proper prefix, empty if none is."""
        if piece not in self.shorter:
            self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.machine), "")
        return self.shorter[piece]

    def _apart(self, left: str, right: str) -> bool:
        """Whether the two pieces stay two when merged anew: no pair across them is due before the merges that made them.

        Their merges are undone from the last to the first, of equals the one on the right.
        """
        if self.ties:
            return merged(left + right, self.score) == [left, right]
        rank, joint = self.rank, self.joint
        due = len(rank)
        while True:
            if rank.get(left + right, due) < due:
                return False
            a, b = joint[left], joint[right]
            here, there = rank[left] if a else -1, rank[right] if b else -1
            if here > there:
                due, left = here, left[a:]
            elif b:  # an equal pair further left comes first
                due, right = there + 1, right[:b]
            else:
                return True

    def _step(self, last: str, match: str) -> str:
        """The longest of ``match`` and its shorter pieces that stays apart from the last piece; empty if none does."""
        piece = match
        while last and piece and not self._apart(last, piece):
            piece = self._next_shorter(piece)
        if self.n_steps >= REMEMBER:
            self.steps.clear()
            self.n_steps = 0
        self.steps.setdefault(last, {})[match] = piece
        self.n_steps += 1
        return piece

    def _backtrack(self, text: str) -> list[str]:
        size = len(text)
        longest, steps = self.machine.iter_long, self.steps
        shut = 0  # positions from which nothing fits
        out: list[str] = []
        pos, last = 0, ""
        ahead = longest(text)
        end, match = next(ahead)  # where the match of the search ends, and the piece to try
        while pos < size:
            try:
                piece = steps[last][match]
            except KeyError:
                piece = self._step(last, match)
            if shut and piece and shut >> pos + len(piece) & 1:
                match = self._next_shorter(piece)
            elif piece:
                out.append(piece)
                last = piece
                pos += len(piece)
                if pos < size:
                    if pos != end + 1:
                        ahead = longest(text, pos)
                    end, match = next(ahead)
            else:
                shut |= 1 << pos
                piece = out.pop()
                pos -= len(piece)
                last = out[-1] if out else ""
                match = self._next_shorter(piece)
        return out

    def _cuts(self, part: str) -> list[str]:
        """The part between two symbols each that no piece holds side by side; a symbol unknown to the model is alone."""
        if self.beside.issuperset(map(add, part, part[1:])):
            return [part]
        at = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in self.beside]
        return [part[i:j] for i, j in zip([0, *at], [*at, len(part)])]

    def _behind_space(self, word: str) -> bytes:
        """Ids of a word behind a space symbol."""
        first, *others = self._cuts(SPACE + word)
        if not others:
            return self._uncut(first)
        return b"".join([self.parts[first[1:]], *map(self.starts.__getitem__, others)])

    def _part(self, part: str) -> bytes:
        """Ids of a part as it stands."""
        first, *others = self._cuts(part)
        return b"".join([self._uncut(first), *map(self.starts.__getitem__, others)])

    def _uncut(self, part: str) -> bytes:
        """Ids of symbols between two cuts."""
        if len(part) < 2:
            found = self.packed.get(part)
            return b"".join(self.byte[b].to_bytes(4, "little") for b in part.encode("utf-8", "surrogatepass")) if found is None else found
        # space runs have pieces of equal score, to which the pairwise test does not apply;
        # a giant part is merged directly, whose time does not depend on the bitfield's width
        direct = part.startswith(SPACE * 2) or len(part) > 1000
        return b"".join(map(self.packed.__getitem__, merged(part, self.score) if direct else self._backtrack(part)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with the begin and end ids."""
        found: list[bytes] = []
        if self.line is None or text[:1] == " " or "  " in text or SPACE in text:
            for part in self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else ():
                found.append(self._part(part) if part.startswith(SPACE * 2) else self.parts[part[1:]])
        elif text:  # single spaces only: parts are words, with a space symbol unless they start a line
            for n, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if n:
                    found += self.line, self.starts[words.pop(0)]
                found += map(self.parts.__getitem__, words)
        return b"".join([self.model.begin.to_bytes(4, "little"), *found, self.model.end.to_bytes(4, "little")])

    def forget(self) -> None:
        """Empty the tables, which hold the encoder as it holds them."""
        self.parts.forget()
        self.starts.forget()
        self.steps.clear()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids; the space that encoding puts first goes."""
        first = next((i for i in ids if self.surface[i]), None)
        raw = b"".join(map(self.surface.__getitem__, ids))
        if first is not None and self.model.pieces[first].startswith(SPACE):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _encode_batches(model: MergeModel, names: list[str]):
    def run(batches):
        encoder = Encoder(model)
        try:
            yield from encoded(encoder, batches)
        finally:
            encoder.forget()  # its tables go with the partition, as Python workers live on

    def encoded(encoder, batches):
        for batch in batches:
            texts = batch["_text"]
            start = 0
            while start < batch.num_rows:
                packed, plain, size, end = [], [], 0, start
                while end < batch.num_rows and size < OUT_BYTES:
                    text = texts[end].as_py() or ""
                    raw = encoder.encode(text)
                    packed.append(raw)
                    plain.append(encoder.decode(memoryview(raw).cast("I").tolist()))
                    size += len(text)
                    end += 1
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in names), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()), pa.array(plain, pa.string())],
                    names=[*names, "n_tokens", "ids", "decoded"],
                )
                start = end

    return run


def encode_texts(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_tokens, ids (little-endian unsigned 32-bit, begin and end included) and decoded.

    A null text counts as empty: its ids are begin and end, its decoded text is
    empty. Columns of ``docs`` named like a result are replaced. The model file
    is read by the driver and sent with the tasks.
    """
    text_batches(docs)
    model = MergeModel(model_path)
    names = [c for c in docs.columns if c not in (text, "n_tokens", "ids", "decoded", "_text")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in names)
    return docs.select(*names, F.col(text).cast("string").alias("_text")).mapInArrow(
        _encode_batches(model, names), f"{schema}n_tokens long, ids binary, decoded string"
    )
