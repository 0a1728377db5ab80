"""SentencePiece encoding by Viterbi search over a stream, and decoding.

The best split of a text into pieces is found left to right. Only the last positions, as many as the longest
piece has characters, can still be extended; where the back pointers of all of them lead to one boundary, the
ids before it are final and leave. So a text of any length is encoded in bounded memory.

Scores: a unigram model brings log probabilities. A model made by byte pairs only ranks its pieces; rank r
then counts as the log probability of Zipf's law, -log(r + 2.7). Scores are whole millionths, so sums are
exact and ties go to the longer last piece.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Below the worst piece by this much lies a character that is no piece, as in the public implementation.
UNKNOWN = 10.0


class Pieces:
    """Pieces of a model with their scores, as a trie of nodes: (look up a child by character, id, score); id -1 is no piece."""

    def __init__(self, names: list[str], scores: list[float], kinds: list[str], unknown_id: int = 0):
        self.names, self.kinds, self.unknown_id = names, kinds, unknown_id
        usable = [i for i, k in enumerate(kinds) if k == "piece"]
        self.bytes = {int(names[i][1:-1], 16): i for i, k in enumerate(kinds) if k == "byte"}
        whole = {names[i]: (i, round(scores[i] * 1e6)) for i in usable}
        root: dict = {}
        self.trie = (root.get, -1, 0)
        children = {"": root}
        for name in whole:
            for k in range(1, len(name) + 1):
                if name[:k] not in children:
                    own = children[name[:k]] = {}
                    children[name[: k - 1]][name[k - 1]] = (own.get, *whole.get(name[:k], (-1, 0)))
        self.longest = max((len(names[i]) for i in usable), default=1)
        self.unknown = round((min((scores[i] for i in usable), default=0.0) - UNKNOWN) * 1e6)
        #: No piece goes on with a blank after another character, so every such place is a boundary of all paths.
        self.lines_part = not any("\n" in names[i] for i in usable)
        self.blanks_part = not any(re.search(f"[^{BLANK}]{BLANK}", names[i]) for i in usable)

    @classmethod
    def of(cls, model) -> Pieces:
        """From a loaded sentencepiece model."""
        n = model.get_piece_size()
        kinds = ["byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece" for i in range(n)]
        scores = [model.get_score(i) for i in range(n)]
        plain = [s for s, k in zip(scores, kinds, strict=True) if k == "piece"]
        if all(s == int(s) for s in plain):
            scores = [-math.log(max(-s, 0.0) + 2.7) for s in scores]
        return cls([model.id_to_piece(i) for i in range(n)], scores, kinds, model.unk_id())

    def spelled(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if all(b in self.bytes for b in raw) else [self.unknown_id]


class StreamingViterbi:
    """Feed characters, get ids as soon as they are final; ``end`` gives the rest.

    ``score``, ``back`` and ``piece`` hold, for each boundary since the last final one, the best way to it.
    ``widest`` is the largest number of boundaries that were held: the longest piece, and what was fed at once.
    """

    def __init__(self, pieces: Pieces):
        self.p, self.widest = pieces, 0
        self._start()

    def _start(self) -> None:
        self.text, self.done = "", 0
        self.score: list[int | None] = [0]
        self.back, self.piece = [0], [-1]

    def feed(self, more: str) -> list[int]:
        self._add(more)
        return self._advance(len(self.text) - self.p.longest)

    def end(self, more: str = "") -> list[int]:
        if more:
            self._add(more)
        ids = self._advance(len(self.text))
        ids += self._path(len(self.text))
        self._start()
        return ids

    def _add(self, more: str) -> None:
        n = len(more)
        self.text += more
        self.score += [None] * n
        self.back += [0] * n
        self.piece += [-1] * n
        self.widest = max(self.widest, len(self.score))

    def _advance(self, until: int) -> list[int]:
        """Extends all boundaries before ``until``, where every piece that starts there is in sight."""
        out: list[int] = []
        every, n = 2 * self.p.longest, len(self.text)
        text, score, back, piece = self.text, self.score, self.back, self.piece
        first, longest, unknown = self.p.trie[0], self.p.longest, self.p.unknown
        i = self.done
        while i < until:
            here = score[i]
            if here is not None:
                child, j, alone = first, i, False
                for c in text[i : i + longest]:
                    node = child(c)
                    if node is None:
                        break
                    j += 1
                    child, id_, new = node
                    if id_ >= 0:
                        new += here
                        old = score[j]
                        # Starts come in ascending order, so of equal scores the first, the longer piece, stays.
                        if old is None or new > old:
                            score[j] = new
                            back[j] = i
                            piece[j] = id_
                        if j == i + 1:
                            alone = True
                if not alone:
                    new, old = here + unknown, score[i + 1]
                    if old is None or new > old:
                        score[i + 1], back[i + 1], piece[i + 1] = new, i, -2
            i += 1
            if i % every == 0 and i < n:
                self.done = i
                out += self._commit()
                until -= n - len(self.text)
                i, n = self.done, len(self.text)
                text, score, back, piece = self.text, self.score, self.back, self.piece
        self.done = max(i, self.done)
        return out

    def _path(self, end: int) -> list[int]:
        ids: list[int] = []
        while end > 0:
            i, piece = self.back[end], self.piece[end]
            if piece == -2:
                ids += reversed(self.p.spelled(self.text[i:end]))
            else:
                ids.append(piece)
            end = i
        ids.reverse()
        return ids

    def _commit(self) -> list[int]:
        """Where all ways to the open boundaries meet, what lies before is final."""
        alive = {j for j in range(self.done, min(self.done + self.p.longest, len(self.score))) if self.score[j] is not None}
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(self.back[last])
        at = alive.pop()
        if at == 0:
            return []
        ids = self._path(at)
        base = self.score[at]
        self.text, self.done = self.text[at:], self.done - at
        self.score = [None if s is None else s - base for s in self.score[at:]]
        self.back = [b - at for b in self.back[at:]]
        self.piece = self.piece[at:]
        self.back[0], self.piece[0] = 0, -1
        return ids


class Codec:
    """Encoding and decoding of whole texts with one model.

    Blanks become ``BLANK`` and one is put before the text. No piece goes over a line end, and none holds a
    blank after another character (else ``parts`` is the whole text); so all paths meet there, and a stretch
    between two such boundaries has the same ids wherever it stands. Short stretches are remembered, at most
    twice ``memory`` of them; longer ones are streamed in blocks.
    """

    def __init__(self, pieces: Pieces, memory: int = 300_000, block: int = 1024):
        self.p, self.memory, self.block = pieces, memory, block
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.parted = pieces.blanks_part and pieces.lines_part
        self.parts = re.compile(f"{BLANK}*[^{BLANK}]*")
        self.search = StreamingViterbi(pieces)
        raw = {i: bytes([b]) for b, i in pieces.bytes.items()}
        self.spelling = [raw.get(i, name.encode("utf-8")) for i, name in enumerate(pieces.names)]

    def stream(self, stretch: str) -> list[int]:
        if len(stretch) <= self.block:
            return self.search.end(stretch)
        ids: list[int] = []
        for lo in range(0, len(stretch), self.block):
            ids += self.search.feed(stretch[lo : lo + self.block])
        return ids + self.search.end()

    def _new(self, word: str) -> list[int]:
        """Ids of a word after a blank that ``young`` doesn't have."""
        ids = self.old.get(word)
        if ids is None:
            ids = self.stream(BLANK + word)
        if len(word) <= 64:
            if len(self.young) >= self.memory:
                self.young, self.old = {}, self.young
            self.young[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.parted:
            return self.stream(BLANK + text.replace(" ", BLANK))
        out: list[int] = []
        line_end = self.p.spelled("\n")
        for n, line in enumerate((" " + text).split("\n")):
            if n:
                out += line_end
            if BLANK in line or "  " in line or line.endswith(" "):
                for found in self.parts.finditer(line.replace(" ", BLANK)):
                    if found[0]:
                        out += self.stream(found[0])
                continue
            head, *rest = line.split(" ")
            if head:
                out += self.stream(head)
            for word in rest:
                out += self.young.get(word) or self._new(word)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text; byte pieces are joined before they are read as UTF-8."""
        joined = b"".join(map(self.spelling.__getitem__, ids))
        return joined.decode("utf-8", "surrogatepass").replace(BLANK, " ")[1:]


def public_codec() -> Codec:
    """With the public byte pair model of 32,000 pieces."""
    import public_tokenizers as public
    from sentencepiece import SentencePieceProcessor

    return Codec(Pieces.of(SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))))


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", codec: Callable[[], Codec] = public_codec) -> DataFrame:
    """One row per document: id and ``ids``. Null text gives no ids, as does an empty one; rows are independent."""

    @F.pandas_udf("array<int>")
    def ids_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with_model = codec()
        for s in series:
            yield pd.Series([np.array(with_model.encode(x or ""), dtype=np.int32) for x in s], dtype="object")

    return docs.select(F.col(id), ids_of(F.col(text)).alias("ids"))


def decode(rows: DataFrame, id: str = "doc_id", ids: str = "ids", codec: Callable[[], Codec] = public_codec) -> DataFrame:
    """One row per row: id and ``text``; null ids are none. The mark for blanks itself comes back as a blank."""

    @F.pandas_udf("string")
    def text_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with_model = codec()
        for s in series:
            yield pd.Series([with_model.decode([] if x is None else list(x)) for x in s], dtype="object")

    return rows.select(F.col(id), text_of(F.col(ids)).alias("text"))


def round_trip(docs: DataFrame, id: str = "doc_id", text: str = "text", codec: Callable[[], Codec] = public_codec) -> DataFrame:
    """One row per document: id, ``n_tokens``, ``ids_crc32`` (little-endian unsigned 32-bit ids) and ``decoded_sha256``.

    Ids stay in the task: the text is encoded, and what the ids decode to is hashed.
    """

    @F.pandas_udf("n_tokens long, ids_crc32 long, decoded string")
    def both(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with_model = codec()
        for s in series:
            rows = []
            for x in s:
                ids = with_model.encode(x or "")
                rows.append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), with_model.decode(ids)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_crc32", "decoded"])

    found = docs.select(F.col(id), both(F.col(text)).alias("x"))
    return found.select(id, "x.n_tokens", "x.ids_crc32", F.sha2("x.decoded", 256).alias("decoded_sha256"))
