"""Token counts by a compiled finite-state form of a byte-level BPE tokenizer.

Two deterministic transducers take the place of the tokenizer:

* ``Splitter`` reads character classes and marks where the pre-tokenizer starts a
  new piece. It has 13 states, so a chunk of text is summed up as a state map
  (entry state -> exit state). Maps are computed for all chunks and all entry
  states in lockstep and composed by a parallel prefix scan, which gives every
  chunk its entry state; a second pass then marks the piece starts.
* ``PieceTransducer`` reads the bytes of a piece and annotates each transition with
  the tokens it adds to (or takes from) the count. The last token of every
  prefix of a BPE encoding is fixed by the last tokens of shorter prefixes, so a
  state holds, for each suffix that some vocabulary entry continues, the token
  before it and the count there. States are compiled as texts need them and
  kept for the life of the worker; all pieces of a block advance in lockstep.
  A long piece is cut into chunks whose partial state maps are composed in order.

Nothing of the text is left out, and no count is estimated.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CHUNK = 256
_TAIL = 32
#: Texts are counted in blocks of about this many characters.
BLOCK_CHARS = 1_000_000
#: Compiled states a worker keeps; pieces that need more are merged directly.
MAX_STATES = 300_000
#: States found first are met most often; the transitions of these are kept in a table, of the others in a dict.
TABLE_STATES = 100_000
_WIDTH = 128
_LONG_PIECE = 2048

# Character classes. The letters of the contractions 's 't 'm 'd 're 've 'll have their own.
_L, _N, _O, _SP, _WS, _AP, _STMD, _R, _V, _LL, _E, _END = range(12)
_UNKNOWN = 255
# States of the splitter.
_START, _IN_L, _IN_N, _IN_O, _ONE_SP, _ONE_WS, _RUN_SP, _RUN_WS, _AT_AP, _AP_R, _AP_V, _AP_L, _DONE = range(13)
_HERE, _BEFORE = 1, 2  # a piece starts at this character; one starts at the character before


def _splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    letters = (_L, _STMD, _R, _V, _LL, _E)
    goes, marks = np.zeros((13, 12), np.uint8), np.zeros((13, 12), np.uint8)
    into = {**dict.fromkeys(letters, _IN_L), _N: _IN_N, _O: _IN_O, _SP: _ONE_SP, _WS: _ONE_WS, _AP: _AT_AP, _END: _START}
    for state in range(13):
        for c in range(12):
            goes[state, c], marks[state, c] = into[c], _HERE
    for c in letters:
        marks[_IN_L, c] = 0
    marks[_IN_N, _N] = 0
    for c in (_O, _AP):
        for state in (_IN_O, _AT_AP):
            goes[state, c], marks[state, c] = _IN_O, 0
    for state in (_ONE_SP, _ONE_WS, _RUN_SP, _RUN_WS):
        goes[state, _SP], marks[state, _SP] = _RUN_SP, 0
        goes[state, _WS], marks[state, _WS] = _RUN_WS, 0
        run = state in (_RUN_SP, _RUN_WS)
        for c in (*letters, _N, _O, _AP):
            # The last character of a run stands apart; a space joins what follows.
            spaced = state in (_ONE_SP, _RUN_SP)
            marks[state, c] = (0 if spaced else _HERE) | (_BEFORE if run else 0)
            if spaced and c == _AP:
                goes[state, c] = _IN_O
    goes[_AT_AP, _STMD], marks[_AT_AP, _STMD] = _DONE, 0
    for c, state, last in ((_R, _AP_R, _E), (_V, _AP_V, _E), (_LL, _AP_L, _LL)):
        goes[_AT_AP, c], marks[_AT_AP, c] = state, 0
        # Not a contraction after all: the letter started a piece.
        goes[state], marks[state] = goes[_IN_L], marks[_IN_L] | _BEFORE
        goes[state, last], marks[state, last] = _DONE, 0
    return goes, marks


class Splitter:
    """Piece starts of the pattern 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|spaces."""

    GOES, MARKS = _splitter_tables()

    def __init__(self, pre_tokenizer):
        self.library = pre_tokenizer
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        for letters, c in (("stmd", _STMD), ("r", _R), ("v", _V), ("l", _LL), ("e", _E), ("'", _AP), (" ", _SP)):
            for letter in letters:
                self.classes[ord(letter)] = c

    def _classify(self, point: int) -> int:
        """Asks the library how it treats the character, so its Unicode tables are the ones used."""
        c = chr(point)

        def pieces(text: str) -> int:
            return len(self.library.pre_tokenize_str(text))

        if pieces("a" + c) == 1:
            return _L
        if pieces("1" + c) == 1:
            return _N
        return _O if pieces("!" + c) == 1 else _WS

    def _maps(self, columns: np.ndarray) -> np.ndarray:
        """Exit state of each column of symbols for each of the 13 entry states."""
        maps = np.tile(np.arange(13, dtype=np.uint8), (columns.shape[1], 1))
        flat = self.GOES.ravel()
        for row in columns:
            maps = flat[maps * np.uint8(12) + row[:, None]]
        return maps

    def starts(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Positions at which pieces start. ``ends`` are the positions that end a segment of text."""
        symbols = self.classes[points]
        symbols[ends] = _END
        for point in np.unique(points[symbols == _UNKNOWN]):
            self.classes[point] = self._classify(int(point))
        symbols = self.classes[points]
        symbols[ends] = _END
        n = len(symbols)
        chunks = -(-n // _CHUNK)
        columns = np.full(chunks * _CHUNK, _END, np.uint8)
        columns[:n] = symbols
        columns = np.ascontiguousarray(columns.reshape(chunks, _CHUNK).T)
        # State maps of all chunks. Where the chunk's end alone sends every state to the same one, so does the chunk.
        flat = self.GOES.ravel()
        maps = self._maps(columns[-_TAIL:])
        open_ = np.flatnonzero((maps != maps[:, :1]).any(axis=1))
        if len(open_):
            maps[open_] = self._maps(np.ascontiguousarray(columns[:, open_]))
        # The scan: after each round a map spans twice as many chunks.
        reach = 1
        while reach < chunks:
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.int64), axis=1)
            reach *= 2
        state = np.concatenate([[_START], maps[:-1, _START]]).astype(np.int64)
        marks = np.empty((_CHUNK, chunks), np.uint8)
        mark = self.MARKS.ravel()
        for i, row in enumerate(columns):
            key = state * 12 + row
            marks[i] = mark[key]
            state = flat[key].astype(np.int64)
        marks = marks.T.ravel()[:n]
        started = (marks & _HERE).astype(bool)
        started[:-1] |= (marks[1:] & _BEFORE).astype(bool)
        return np.flatnonzero(started)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceTransducer:
    """Counts BPE tokens of byte strings with transitions compiled on demand."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        alphabet = _byte_alphabet()
        self.name = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if all(c in alphabet for c in token)}
        self.bytes_of = {i: b for b, i in self.name.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for order, merge in enumerate(merges):
            left, right = (vocabulary[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = (order, self.name[self.bytes_of[left] + self.bytes_of[right]])
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for word, i in self.name.items():
            node = 0
            for b in word:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][b]
            self.token[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state is packed as (node, token before, count) for each suffix, longest first.
        start = array("i", (0, -1, 0)).tobytes()
        self.states: list[bytes] = [start]
        self.known = {start: 0}
        self.column = np.full(256, -1, np.int64)
        self.columns = 0
        self.next = np.full(1024 * _WIDTH, -1, np.int32)
        self.adds = np.zeros(1024 * _WIDTH, np.int8)
        self.rare: dict[int, tuple[int, int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The plain merge procedure; used for single pairs and as the fallback."""
        ids = [self.name[piece[i:i + 1]] for i in range(len(piece))]
        while len(ids) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank), default=None)
            if best is None:
                break
            left, right = ids[best[1]], ids[best[1] + 1]
            new, out, i = self.rank[left, right][1], [], 0
            while i < len(ids):
                if i + 1 < len(ids) and ids[i] == left and ids[i + 1] == right:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _adjoin(self, left: int, right: int) -> bool:
        """Whether the two tokens are what BPE makes of their bytes; an encoding is right if all neighbours are."""
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            if left < 0:
                self.pairs[key] = self.merge(self.bytes_of[right]) == [right]
            else:
                self.pairs[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return self.pairs[key]

    def _compile(self, state: int, byte: int) -> tuple[int, int] | None:
        """Adds one transition (target, tokens added); None when there is no room for its target."""
        packed = array("i", self.states[state])
        entries: list[int] = []
        last, gain = -1, 0
        for at in range(0, len(packed), 3):
            child = self.child[packed[at]].get(byte)
            if child is None:
                continue
            before, count = packed[at + 1], packed[at + 2]
            token = self.token[child]
            if last < 0 and token >= 0 and self._adjoin(before, token):
                last, gain = token, count + 1
            if self.child[child]:
                entries += (child, before, count)
        for at in range(2, len(entries), 3):
            entries[at] -= gain
        target = array("i", (*entries, 0, last, 0)).tobytes()
        found = self.known.get(target)
        if found is None:
            found = len(self.states)
            if found >= MAX_STATES:
                return None
            self.known[target] = found
            self.states.append(target)
            if found * _WIDTH >= len(self.next) and found < TABLE_STATES:
                self.next = np.concatenate([self.next, np.full(len(self.next), -1, np.int32)])
                self.adds = np.concatenate([self.adds, np.zeros(len(self.adds), np.int8)])
        if self.column[byte] < 0 and self.columns < _WIDTH:
            self.column[byte] = self.columns
            self.columns += 1
        if state < TABLE_STATES and self.column[byte] >= 0:
            key = state * _WIDTH + self.column[byte]
            self.next[key], self.adds[key] = found, gain
        else:
            self.rare[state << 8 | byte] = (found, gain)
        return found, gain

    def step(self, state: int, byte: int) -> tuple[int, int] | None:
        column = self.column[byte]
        if state < TABLE_STATES and column >= 0:
            key = state * _WIDTH + column
            target = self.next[key]
            return (int(target), int(self.adds[key])) if target >= 0 else self._compile(state, byte)
        return self.rare.get(state << 8 | byte) or self._compile(state, byte)

    def run(self, state: int, chunk: bytes) -> tuple[int, int] | None:
        """(exit state, tokens added) of a chunk from one entry state; None without room for a state."""
        total = 0
        for byte in chunk:
            got = self.step(state, byte)
            if got is None:
                return None
            state, total = got[0], total + got[1]
        return state, total

    def _long(self, piece: bytes) -> int:
        """A long piece: partial state maps of its distinct chunks, composed in order."""
        maps: dict[tuple[bytes, int], tuple[int, int] | None] = {}
        state, total = 0, 0
        for at in range(0, len(piece), _CHUNK):
            key = (piece[at:at + _CHUNK], state)
            if key not in maps:
                maps[key] = self.run(state, key[0])
            if maps[key] is None:
                return len(self.merge(piece))
            state, total = maps[key][0], total + maps[key][1]
        return total

    def counts(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each piece of ``data``."""
        out = np.zeros(len(start), np.int64)
        order = np.argsort(-length, kind="stable")
        order = order[length[order] > 0]
        long = int((length[order] > _LONG_PIECE).sum())
        raw = data.tobytes() if long else b""
        for i in order[:long]:
            out[i] = self._long(raw[start[i]:start[i] + length[i]])
        order = order[long:]
        begin, size = start[order].astype(np.int64), length[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        failed = np.zeros(len(order), bool)
        # Pieces are sorted by falling length, so those still running are a prefix.
        running = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
        for step, n in enumerate(running):
            byte = data[begin[:n] + step]
            column = self.column[byte]
            now = state[:n]
            tabled = (now < TABLE_STATES) & (column >= 0)
            key = np.where(tabled, now * _WIDTH + column, 0)
            target, gain = self.next[key], self.adds[key].astype(np.int64)
            odd = np.flatnonzero(~tabled | (target < 0))
            if len(odd):
                target = target.astype(np.int64)
                pairs, back = np.unique(now[odd] << 8 | byte[odd], return_inverse=True)
                got = [self.step(int(k) >> 8, int(k) & 255) for k in pairs]
                target[odd] = np.array([g[0] if g else -1 for g in got])[back]
                gain[odd] = np.array([g[1] if g else 0 for g in got])[back]
                lost = odd[target[odd] < 0]
                failed[lost] = True
                target[lost] = 0
            total[:n] += gain
            state[:n] = target
        for i in np.flatnonzero(failed):
            total[i] = len(self.merge(data[begin[i]:begin[i] + size[i]].tobytes()))
        out[order] = total
        return out


class TokenCounter:
    """Counts as the tokenizers library gives them, without its added special tokens."""

    _open: dict[str, TokenCounter] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        plain = (
            spec.get("normalizer") is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"]["use_regex"]
            and not spec["pre_tokenizer"]["add_prefix_space"] and model["type"] == "BPE" and not model.get("ignore_merges"))
        if not plain:
            raise ValueError("only byte-level BPE files without a normaliser can be compiled")
        self.splitter = Splitter(Tokenizer.from_file(path).pre_tokenizer)
        self.transducer = PieceTransducer(model["vocab"], model["merges"])
        # Strings of added tokens stand for one token each, wherever they occur.
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    @classmethod
    def shared(cls, path: str) -> TokenCounter:
        """One per worker process, so compiled states outlive a task."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _block(self, segments: list[str]) -> np.ndarray:
        joined = "\n".join(segments) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        starts = self.splitter.starts(points, ends)
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) == len(points):
            at = np.arange(len(points) + 1)
        else:
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            at = np.concatenate([[0], np.cumsum(width)])
        stops = np.append(starts[1:], len(points))
        inner = points[starts] != 10
        inner |= ~np.isin(starts, ends)
        starts, stops = starts[inner], stops[inner]
        begin = at[starts]
        counts = self.transducer.counts(data, begin, at[stops] - begin)
        owner = np.searchsorted(ends, starts)
        return np.bincount(owner, weights=counts, minlength=len(segments)).astype(np.int64)

    def count(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        block: list[str] = []
        owner: list[int] = []
        size = 0

        def close() -> None:
            nonlocal block, owner, size
            if block:
                for i, n in zip(owner, self._block(block), strict=True):
                    out[i] += int(n)
            block, owner, size = [], [], 0

        for i, text in enumerate(texts):
            parts = self.added.split(text) if text and self.added else [text or ""]
            out[i] += len(parts) - 1
            for part in parts:
                if part:
                    block.append(part)
                    owner.append(i)
                    size += len(part) + 1
            if size > BLOCK_CHARS:
                close()
        close()
        return out


def with_token_counts(docs: DataFrame, path: str, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` plus the number of tokens of its text; null and empty texts have 0. Rows stay as they
    are; an input column of that name is replaced."""
    docs = docs.drop(name)
    names = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.shared(path)
        for batch in batches:
            counts = counter.count(batch.column("_counted").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(counts, pa.int64())], [*names, name])

    return docs.withColumn("_counted", F.col(text_col)).mapInArrow(run, StructType([*docs.schema.fields]).add(name, "long"))
