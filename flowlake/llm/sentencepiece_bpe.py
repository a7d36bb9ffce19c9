"""Encoding and decoding with a merge-type SentencePiece vocabulary.

A text becomes symbols, one per character; all neighbouring pairs that form a
vocabulary piece wait in an agenda ordered by the piece's score, then by place;
the best is merged and its new neighbours join the agenda until it is empty.
Symbols that are no piece fall back to their bytes. The agendas of short cuts of a
text are the rows of one array and are worked off side by side.

No piece joins a character to a following space mark, and none holds a line
feed, so texts are cut at both; a cut falls into parts between characters that
no piece has side by side. The ids of short cuts and parts met lately are kept in a
bounded memory of each Python worker, in two generations. Every cut is compared with the
sentencepiece library when it is first encoded, and every text's decoding is
compared with the library's; a difference stops the job. Both comparisons are
made for a whole Arrow batch at a time.

Defined results: a null or empty text is the end id alone and decodes to an
empty text; repeated rows are encoded alike; an empty table gives an empty one;
only the named columns are kept, so other columns can have any name.
"""

from __future__ import annotations

import gc
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowlake.llm.hashing import slices

SPACE = "▁"
# Cuts, and parts, of a generation that a worker remembers, each of so many characters
# at most; there are two generations of both. Longer ones are encoded anew each time.
REMEMBERED = 125_000
LONGEST_REMEMBERED = 40
# Cuts up to this length are encoded many at a time; longer ones part by part, and parts
# up to this length keep their agenda as a list.
SHORT = 48
# Cells of the agendas of so many cuts.
AGENDA_CELLS = 400_000
NEVER = float("inf")
# The table of pairs has two to this power of slots; a multiplier spreads the keys.
SLOT_BITS = 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)
# Cuts, one a line, that the library encodes in one text to compare with.
COMPARED = 64
# Texts decoded at a time.
DECODED = 100


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Memory:
    """What was met lately: when the young generation is full it becomes the old one,
    whose entries are forgotten unless they were met again in the meantime."""

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most = most
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def get(self, key: str) -> tuple[int, ...] | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: tuple[int, ...]) -> None:
        if len(key) > LONGEST_REMEMBERED:
            return
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def among(self, keys: set[str]) -> dict[str, tuple[int, ...]]:
        """The remembered ones of many."""
        found = {key: self.young[key] for key in self.young.keys() & keys}
        if self.old:
            again = {key: self.old[key] for key in self.old.keys() & (keys - found.keys())}
            self.put_all(again)
            found |= again
        return found

    def put_all(self, entries: dict[str, tuple[int, ...]]) -> None:
        waiting = ((key, value) for key, value in entries.items() if len(key) <= LONGEST_REMEMBERED)
        while True:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            some = dict(islice(waiting, self.most - len(self.young)))
            if not some:
                return
            self.young.update(some)


class MergeVocabulary:
    """Pieces, scores and byte fallbacks of one model file's content."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        size = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(size)]
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        self.ids = {names[i]: i for i in range(size) if not special[i]}
        self.priority = {names[i]: -lib.get_score(i) for i in range(size) if not special[i] and len(names[i]) > 1}
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.end_id = lib.eos_id()
        if len(self.byte_ids) != 256 or self.end_id < 0:
            raise ValueError("the model needs byte fallback and an end id")
        if any(SPACE in name.lstrip(SPACE) or "\n" in name for name in self.ids):
            raise ValueError("a piece crosses a word boundary")
        self.bytes_of = [b""] * size
        for name, i in self.ids.items():
            self.bytes_of[i] = name.replace(SPACE, " ").encode()
        for value, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([value])
        self.joined = {name[i:i + 2] for name in self.priority for i in range(len(name) - 1)}
        self.known, self.known_parts = Memory(), Memory()
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Numbers for what can become a symbol (pieces, and the characters in them), and
        the pairs of symbols that make a piece, by slot, with priority and result."""
        symbols = list(dict.fromkeys(chain(self.ids, chain.from_iterable(self.ids))))
        number = {symbol: i for i, symbol in enumerate(symbols)}
        # Of a character in no piece, which makes no pair.
        self.stranger = len(symbols)
        self.number_of = np.full(0x110000, self.stranger, np.int32)
        for symbol, i in number.items():
            if len(symbol) == 1:
                self.number_of[ord(symbol)] = i
        self.token_of = np.array([self.ids.get(symbol, -1) for symbol in symbols] + [-1], np.int32)
        pairs = [
            (number[name[:i]] * self.stranger + number[name[i:]], self.priority[name], number[name])
            for name in self.priority for i in range(1, len(name)) if name[:i] in number and name[i:] in number
        ]
        keys, priorities, results = (np.array(c) for c in zip(*pairs))
        slots = _slots(keys)
        order, sizes = np.argsort(slots, kind="stable"), np.bincount(slots, minlength=1 << SLOT_BITS)
        self.slot_starts = (np.cumsum(sizes) - sizes).astype(np.int32)
        self.largest_slot = int(sizes.max())
        # No key behind the last ones.
        self.pair_keys = np.append(keys[order].astype(np.int64), np.full(self.largest_slot, -1))
        padding = np.zeros(self.largest_slot)
        self.pair_priorities = np.append(priorities[order], padding)
        self.pair_results = np.append(results[order], padding).astype(np.int32)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Priority (NEVER if they make no piece) and result of neighbouring symbols."""
        keys = left.astype(np.int64) * self.stranger + right
        at = self.slot_starts[_slots(keys)]
        fits = self.pair_keys[at] == keys
        for _ in range(self.largest_slot - 1):
            at = np.where(fits, at, at + 1)
            fits = self.pair_keys[at] == keys
        fits &= (left != self.stranger) & (right != self.stranger)
        return np.where(fits, self.pair_priorities[at], NEVER), self.pair_results[at]

    def encode_many(self, cuts: list[str]) -> list[tuple[int, ...]]:
        """Ids of short cuts of one length, all agendas together: a row holds the
        priority of each symbol with its right neighbour; the first smallest is merged,
        and the pairs with both its neighbours are looked up anew, until no row has any."""
        rows, length = len(cuts), len(cuts[0])
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32).reshape(rows, length)
        symbols = self.number_of[codes]
        agenda, results = np.full((rows, length), NEVER), np.zeros((rows, length), np.int32)
        agenda[:, :-1], results[:, :-1] = self._pairs(symbols[:, :-1], symbols[:, 1:])
        before = np.tile(np.arange(-1, length - 1, dtype=np.int32), (rows, 1))
        after = np.tile(np.arange(1, length + 1, dtype=np.int32), (rows, 1))
        alive = np.ones((rows, length), bool)
        open_rows = np.arange(rows)
        while True:
            waiting = agenda[open_rows]
            at = waiting.argmin(axis=1)
            some = waiting[np.arange(len(at)), at] != NEVER
            open_rows, at = open_rows[some], at[some]
            if not len(open_rows):
                break
            right = after[open_rows, at]
            symbols[open_rows, at] = results[open_rows, at]
            alive[open_rows, right] = False
            agenda[open_rows, right] = agenda[open_rows, at] = NEVER
            behind = after[open_rows, right]
            after[open_rows, at] = behind
            for has, left_at, right_at in ((behind < length, at, behind), (before[open_rows, at] >= 0, before[open_rows, at], at)):
                row, one, two = open_rows[has], left_at[has], right_at[has]
                before[row, two] = one
                agenda[row, one], results[row, one] = self._pairs(symbols[row, one], symbols[row, two])
        tokens = self.token_of[symbols]
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        flat = tokens[alive].tolist()
        out = [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]
        for row in np.flatnonzero(((tokens < 0) & alive).any(axis=1)).tolist():
            # Only a single character can be no piece.
            out[row] = tuple(chain.from_iterable(
                (self.byte_ids[b] for b in cuts[row][i].encode()) if tokens[row, i] < 0 else (int(tokens[row, i]),)
                for i in np.flatnonzero(alive[row])))
        return out

    def encode_part(self, part: str) -> tuple[int, ...]:
        """Ids of a part, by the agenda. For the short parts that most are, the
        agenda is a list in text order, whose best entry is the first smallest;
        long ones keep it as a heap."""
        symbols = list(part) if len(part) <= SHORT else self._merge_long(part)
        if 1 < len(part) <= SHORT:
            priority = self.priority.get
            agenda = [priority(pair, NEVER) for pair in map(add, part, part[1:])]
            while agenda and (best := min(agenda)) != NEVER:
                at = agenda.index(best)
                symbols[at] += symbols.pop(at + 1)
                del agenda[at]
                if at:
                    agenda[at - 1] = priority(symbols[at - 1] + symbols[at], NEVER)
                if at < len(agenda):
                    agenda[at] = priority(symbols[at] + symbols[at + 1], NEVER)
        out: list[int] = []
        for symbol in symbols:
            known = self.ids.get(symbol)
            if known is None:
                out.extend(self.byte_ids[b] for b in symbol.encode())
            else:
                out.append(known)
        return tuple(out)

    def _merge_long(self, part: str) -> list[str]:
        symbols: list[str | None] = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        priority = self.priority
        agenda = [(priority[part[i:i + 2]], i, i + 1, part[i:i + 2]) for i in range(n - 1) if part[i:i + 2] in priority]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            # Stale unless both symbols are still the ones that were paired.
            if symbols[left] is None or symbols[right] is None or after[left] != right or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                both = pair + symbols[right]
                if both in priority:
                    heapq.heappush(agenda, (priority[both], left, right, both))
            first = before[left]
            if first >= 0:
                both = symbols[first] + pair
                if both in priority:
                    heapq.heappush(agenda, (priority[both], first, left, both))
        return [s for s in symbols if s is not None]

    def encode_cut(self, cut: str) -> tuple[int, ...]:
        """Ids of one cut, part by part: no merge crosses two characters that
        are neighbours in no piece."""
        joined, known = self.joined, self.known_parts
        ends = [i for i, pair in enumerate(map(add, cut, cut[1:]), 1) if pair not in joined]
        out, at = (), 0
        for end in (*ends, len(cut)):
            part = cut[at:end]
            ids = known.get(part)
            if ids is None:
                ids = self.encode_part(part)
                known.put(part, ids)
            out, at = out + ids if at else ids, end
        return out

    def encode_cuts(self, cuts: list[str]) -> list[tuple[int, ...]]:
        """Ids of cuts of any length."""
        found: list[tuple[int, ...]] = [()] * len(cuts)
        lengths = np.fromiter(map(len, cuts), np.int64, len(cuts))
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=0, append=-1))
        for start, end in pairwise(edges):
            length = int(lengths[order[start]])
            most = max(1, AGENDA_CELLS // length)
            for at in range(start, end, most):
                some = order[at:min(at + most, end)].tolist()
                own = [cuts[i] for i in some]
                for i, ids in zip(some, self.encode_many(own) if length <= SHORT else map(self.encode_cut, own)):
                    found[i] = ids
        return found

    def learn(self, cuts: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of every cut: remembered ones, and new ones compared with the library."""
        known = self.known.among(cuts)
        new = list(cuts.difference(known))
        own = self.encode_cuts(new)
        self._compare(new, own)
        learnt = dict(zip(new, own))
        self.known.put_all(learnt)
        return known | learnt

    def _compare(self, cuts: list[str], own: list[tuple[int, ...]]) -> None:
        """Whether the library gives the same ids. After a line feed it starts afresh,
        so every cut stands alone on a line of its own."""
        lead = self.library.encode("\n")
        feed = (self.byte_ids[10],)
        places = range(0, len(cuts), COMPARED)
        texts = [("\n" + "\n".join(cuts[i:i + COMPARED])).replace(SPACE, " ") for i in places]
        for i, theirs in zip(places, self.library.encode(texts, num_threads=1)):
            some = own[i:i + COMPARED]
            mine = [*lead, *some[0], *chain.from_iterable(map(feed.__add__, some[1:]))]
            if mine != theirs:
                raise ValueError(f"the agenda and the library disagree on {self._differing(cuts[i:i + COMPARED], some)!r}")

    def _differing(self, cuts: list[str], own: list[tuple[int, ...]]) -> str:
        lead = len(self.library.encode("\n"))
        for cut, ids in zip(cuts, own):
            if list(ids) != self.library.encode("\n" + cut.replace(SPACE, " "))[lead:]:
                return cut
        return "\n".join(cuts)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind each other, and where each text begins and the
        last one ends. Every distinct cut's ids are laid out once and copied from there."""
        cuts = [CUTS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.learn(set(chain.from_iterable(cuts)))
        # No cut is empty: this one ends every text.
        known[""] = (self.end_id,)
        for own in cuts:
            own.append("")
        number = dict(zip(known, range(len(known))))
        sizes = np.fromiter(map(len, known.values()), np.int32, len(known))
        ids = np.fromiter(chain.from_iterable(known.values()), np.int32, int(sizes.sum()))
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        lasts = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts))) - 1
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(cuts)), np.int32, int(lasts[-1]) + 1)
        taken = sizes[at]
        ends = np.cumsum(taken, dtype=np.int32)
        places = np.repeat(starts[at] - (ends - taken), taken)
        places += np.arange(len(places), dtype=np.int32)
        return ids[places], np.concatenate([np.zeros(1, np.int32), ends[lasts]])

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        flat, bounds = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in pairwise(bounds.tolist())]

    def decode_flat(self, flat: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts, each compared with the library's."""
        decoded: list[str] = []
        for at in range(0, len(bounds) - 1, DECODED):
            ids = [flat[a:b].tolist() for a, b in pairwise(bounds[at:at + DECODED + 1].tolist())]
            own = self.decode(ids)
            if own != self.library.decode(ids, num_threads=1):
                raise ValueError("own and library decodings differ")
            decoded += own
        return decoded

    def decode(self, ids: list[list[int]]) -> list[str]:
        of = self.bytes_of.__getitem__
        texts = []
        for own in ids:
            text = b"".join(map(of, own)).decode("utf-8", "replace")
            texts.append(text[1:] if text.startswith(" ") else text)
        return texts


CUTS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> MergeVocabulary:
    return MergeVocabulary(model)


def encode_decode(docs: DataFrame, model: bytes, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, ids array<int> and decoded string. `model` is the
    content of the model file, so executors need no copy of it."""
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model)
        # Nothing here is cyclic, and looking for cycles among so many cuts takes long.
        gc.disable()
        try:
            for part in chain.from_iterable(map(slices, batches)):
                ids, bounds = own.encode_flat([t or "" for t in part.column(len(keep)).to_pylist()])
                decoded = own.decode_flat(ids, bounds)
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.ListArray.from_arrays(bounds, ids), pa.array(decoded, pa.string())],
                    [*keep, "ids", "decoded"])
        finally:
            gc.enable()

    schema = T.StructType([docs.schema[c] for c in keep])
    schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
