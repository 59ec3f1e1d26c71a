"""SentencePiece BPE encoding by backtracking over longest matches, and decoding.

The pieces of the model go into an Aho-Corasick automaton. A segment of text
is encoded left to right: at each place the longest piece that starts there is
tried, then its shorter prefixes. A piece may follow its left neighbour only
if merging the two pieces' text anew gives exactly these two pieces; if no piece
fits, the last one is taken back, and its end is marked in a bitfield of
places that lead nowhere. A sequence in which all neighbours fit is the one
that the merge order gives. Characters without a piece of their own end a
segment and become byte pieces.

A piece holds a space mark only at its start or in a run of marks (checked when
the model is read), so text is cut before each run of marks; where no piece
mixes letters with other characters (checked too), also between these. A
bounded table keeps the ids of segments already seen.

Normalisation: what the model asks for here is the identity with a space mark
in front; spaces become marks. Any other normaliser is refused.

Defined results: null counts as empty; an empty text has the begin and end ids
only; texts are encoded whole; repeated rows get equal rows; an empty table
gives an empty result; other columns are not looked at. ``model_path`` is a file of
the driver's machine; its bytes are sent to the executors.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from layerflow.llm.common import ship_code, text_or_empty

MARK = "▁"
CACHE_ENTRIES = 400_000  # segments whose ids a worker remembers, in each of two tables: a full one replaces the other
FIT_ENTRIES = 600_000    # pairs of pieces whose fit a worker remembers; emptied when full
LONG_SEGMENT = 64        # characters; longer segments are not remembered


class Codec:
    def __init__(self, model_bytes: bytes, cache_entries: int = CACHE_ENTRIES):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        probe = "ﬁ Ⅳ  x"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only models with identity normalisation and a space mark in front are supported")
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        self.rank, self.ids, self.bytes_of = {}, {}, {}
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif model.is_control(i):
                self.bytes_of[i] = b""
            elif model.is_unknown(i):
                self.bytes_of[i] = " ⁇ ".encode()
            elif not model.is_unused(i):
                self.ids[piece] = i
                self.rank[piece] = -model.get_score(i)
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece of this model holds a space mark after another character")
        mixed = any(re.search(LETTER, p) and not re.fullmatch(f"{MARK}*{LETTER}+", p) for p in self.ids)
        self.segments = (BY_MARK if mixed else BY_KIND).findall
        self.byte_ids = set(self.byte_id)
        self.chars = {p for p in self.ids if len(p) == 1}
        self.name = {i: p for p, i in self.ids.items()}
        self.size = {i: len(p) for p, i in self.ids.items()}
        self.order = {i: self.rank[p] for p, i in self.ids.items()}
        self.halves: dict[int, tuple[int, int]] = {}  # of a piece: the two that its last merge joins
        self.tree = ahocorasick.Automaton()
        own: set[str] = set()
        for piece, i in self.ids.items():
            last: list[str] = []
            # a piece that its own merges never form cannot occur
            if self.merged(piece, last) == [piece]:
                own.add(piece)
                self.tree.add_word(piece, (len(piece) - 1, i))
                if len(piece) > 1:
                    self.halves[i] = (self.ids[last[0]], self.ids[last[1]])
        self.tree.make_automaton()
        # the longest piece that is a proper prefix of a piece
        self.shorter = {self.ids[p]: next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in own), None) for p in own}
        self.whole = {p: self.ids[p] for p in own}
        top = max(self.rank.values(), default=0)  # runs of marks share the last rank
        self.tied = {i for p, i in self.ids.items() if self.rank[p] == top or set(p) == {MARK}}
        self.fits: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_entries = cache_entries

    # -------------------------------------------------------------- pieces

    def merged(self, text: str, last: list[str] | None = None) -> list[str]:
        """Pieces of a short text by merging the best neighbours first, leftmost among equals.

        ``last`` gets the two parts that the last merge joined.
        """
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                rank = self.rank.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, len(parts[i]) + len(parts[j])))

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or len(parts[i]) + len(parts[j]) != size:
                continue
            if last is not None:
                last[:] = parts[i], parts[j]
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def fit(self, left: int, right: int) -> bool:
        """Whether merging the text of both pieces anew gives both back."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= FIT_ENTRIES:
                self.fits.clear()
            if left in self.tied or right in self.tied:
                names = [self.name[left], self.name[right]]
                known = self.merged("".join(names)) == names
            else:
                known = self._apart(left, right)
            self.fits[key] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Undo the merges of both pieces from the last one on; at no time may the parts that
        meet in the middle have had an earlier merge than the one that was just undone."""
        rank, name, order, halves = self.rank, self.name, self.order, self.halves
        bound, ties = float("inf"), False
        while True:
            across = rank.get(name[left] + name[right])
            # of equal ranks the leftmost merge comes first: one on the left of the middle wins, one on its right loses
            if across is not None and (across < bound or ties and across == bound):
                return False
            a = order[left] if left in halves else -1.0
            b = order[right] if right in halves else -1.0
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, ties = a, False
                left = halves[left][1]
            else:
                bound, ties = b, True
                right = halves[right][0]

    def pieces(self, text: str) -> list[int]:
        """Ids of a segment whose characters all have a piece."""
        whole = self.whole.get(text)
        if whole is not None:
            return [whole]
        n = len(text)
        longest: list[int | None] = [None] * n  # at each place; a later match from one place is longer
        for end, (back, i) in self.tree.iter(text):
            longest[end - back] = i
        size, shorter, fits = self.size, self.shorter, self.fits
        out: list[int] = []
        failed = 0  # bitfield of ends from which the rest can't be encoded
        at, piece = 0, longest[0]
        while True:
            while piece is not None:
                if not (failed and failed >> (at + size[piece]) & 1):
                    if not out:
                        break
                    good = fits.get(out[-1] << 32 | piece)
                    if good or good is None and self.fit(out[-1], piece):
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at += size[piece]
                if at >= n:
                    return out
                piece = longest[at]
            else:
                if not out:
                    raise ValueError("no sequence of pieces fits")
                failed |= 1 << at
                last = out.pop()
                at -= size[last]
                piece = shorter[last]

    # -------------------------------------------------------------- texts

    def _segment(self, text: str) -> bytes:
        if self.chars.issuperset(text):
            ids = self.pieces(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        ids = []
        run: list[str] = []
        for c in text:
            if c in self.chars:
                run.append(c)
            else:
                if run:
                    ids.extend(self.pieces("".join(run)))
                    run = []
                ids.extend(self.byte_id[b] for b in c.encode())
        if run:
            ids.extend(self.pieces("".join(run)))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        out = [struct.pack("<I", self.bos)]
        if text:
            segments = self.segments(MARK + text.replace(" ", MARK))
            found = list(map(self.young.get, segments))
            if None in found:
                for k, ids in enumerate(found):
                    if ids is None:
                        found[k] = self._remembered(segments[k])
            out.extend(found)
        out.append(struct.pack("<I", self.eos))
        return b"".join(out)

    def _remembered(self, segment: str) -> bytes:
        ids = self.young.get(segment) or self.old.get(segment) or self._segment(segment)
        if len(segment) <= LONG_SEGMENT:
            if len(self.young) >= self.cache_entries:
                self.old, self.young = self.young, {}
            self.young[segment] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, marks as spaces, byte pieces read as UTF-8."""
        pieces, table = [], self.bytes_of
        for i in ids:
            pieces.append(table[i])
        raw = b"".join(pieces)
        first = next((i for i in ids if table[i]), None)
        if first is not None and first not in self.byte_ids and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


LETTER = "[A-Za-zÀ-ÖØ-öø-ʯḀ-ỿ]"
#: Segments: marks with the letters, or the other characters, that follow them; or, where pieces mix the two, up to the next mark.
BY_KIND = re.compile(f"{MARK}*(?:{LETTER}+|(?:(?!{LETTER})[^{MARK}])+)|{MARK}+")
BY_MARK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

_CODECS: dict[str, Codec] = {}


def codec(name: str, model_bytes: bytes) -> Codec:
    """The worker's codec of a model, named by the digest of its bytes."""
    if name not in _CODECS:
        _CODECS[name] = Codec(model_bytes)
    return _CODECS[name]


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) and the decoded text."""
    return _run(docs, model_path, "n_tokens bigint, ids binary, decoded string", lambda ids, text: (len(ids) // 4, ids, text))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of ``encode_decode``'s columns."""
    return _run(docs, model_path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))


def _run(docs: DataFrame, model_path: str, columns: str, shown) -> DataFrame:
    ship_code(docs.sparkSession)
    # the model file is read on the driver alone; executors get its bytes (below 1 MB for 32 000 pieces)
    with open(model_path, "rb") as file:
        content = file.read()
    name, model = hashlib.sha256(content).hexdigest(), docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from layerflow.llm import sp_codec

        own = sp_codec.codec(name, model.value)
        names = [c.split()[0] for c in columns.split(", ")]
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = own.encode(text)
                rows.append(shown(ids, own.decode(memoryview(ids).cast("I").tolist())))
            yield pd.concat([batch["doc_id"].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(run, f"doc_id {kind}, {columns}")
