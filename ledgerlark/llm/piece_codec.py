"""Operator 10: SentencePiece encoding and decoding with a table over prefixes.

For a merge-type model every prefix of a text has one encoding, and the encodings of prefixes
agree: the one of a prefix ends in some token, and what comes before it is the encoding of the
shorter prefix. So it is enough to store the last token of each prefix. An automaton over the
vocabulary reports the tokens that end at a place, the longest first; the last token is the one that
stays apart from the token before it when the two are merged as a pair. The ids are read from the
table backwards.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlark.llm.columns import quoted

SPACE = "▁"  # fixed value: the model's sign for a blank
CACHE_UNITS, PAIRS = 400_000, 500_000  # entries of the tables of a worker


class PieceModel:
    """The parts of a model file that encoding and decoding need."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("the model normalises texts in a way that is not built here")
        kinds = pb.ModelProto.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("the model has pieces of a kind that is not built here")
        self.score, self.id, self.byte_id = {}, {}, {}
        for i, piece in enumerate(model.pieces):
            if piece.type == kinds.NORMAL:
                self.id[piece.piece], self.score[piece.piece] = i, piece.score
            elif piece.type == kinds.BYTE:
                self.byte_id[int(piece.piece[1:-1], 16)] = i
        # No token crosses these places, so what lies between them is encoded on its own.
        self.parts_blanks = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.parts_lines = not any("\n" in p for p in self.id)
        order = sorted(set(self.score.values()), reverse=True)
        place = {score: n for n, score in enumerate(order)}
        self.rank = {piece: place[score] for piece, score in self.score.items()}
        self.left: dict[str, list[tuple[str, float]]] = {}
        self.right: dict[str, list[tuple[str, float]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.id, key=len):
            if self.merged(piece) == [piece]:  # a token that merging never makes is never used
                self.automaton.add_word(piece, (len(piece), piece))
                self._note_edges(piece)
        self.automaton.make_automaton()
        self.pieces = {i: p.replace(SPACE, " ").encode() for p, i in self.id.items()}
        self.pieces |= {i: bytes([b]) for b, i in self.byte_id.items()}
        self.apart: dict[tuple[str, str], bool] = {}
        self.before_blank = _Units(self, SPACE)
        self.bare = _Units(self, "")

    def merged(self, text: str) -> list[str]:
        """Merge pairs of neighbours by score, the leftmost of equals first. For short strings.

        ``self.halves`` has what the last merge joined."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = [-1, *range(len(parts) - 1)]
        queue = []
        self.halves = None

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := self.rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (rank, i, parts[i] + parts[j]))

        for i in range(len(parts)):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = after[i]
            if parts[i] is None or j < 0 or parts[i] + parts[j] != both:
                continue
            self.halves = parts[i], parts[j]
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _note_edges(self, token: str) -> None:
        """Which parts lay at the token's edges while it was merged, each with the rank of the merge
        that took it in. Only where ranks grow on the way up; other tokens are merged afresh."""
        last = float("inf")
        if self.halves is None:
            self.left[token] = self.right[token] = [(token, last)]
            return
        one, two = self.halves
        rank = self.rank[token]
        # Single characters are there from the start, whatever their score.
        made = max(self.rank[part] if len(part) > 1 else -1 for part in self.halves)
        if one in self.left and two in self.right and made < rank:
            self.left[token] = [*self.left[one][:-1], (one, rank), (token, last)]
            self.right[token] = [*self.right[two][:-1], (two, rank), (token, last)]

    def stay_apart(self, one: str, two: str) -> bool:
        """Whether merging ``one + two`` leaves just these two.

        Their facing edges grow in the order of rank; they are apart unless two edges that lie side
        by side at some time make a token that comes before the next growth of either."""
        if len(self.apart) > PAIRS:
            self.apart.clear()
        known = self.apart[one, two] = self._apart(one, two)
        return known

    def _apart(self, one: str, two: str) -> bool:
        a, b = self.right.get(one), self.left.get(two)
        if a is None or b is None:
            # A character of no token merges with nothing; other tokens are merged to see.
            return one not in self.id or two not in self.id or self.merged(one + two) == [one, two]
        i = j = 0
        while True:
            edge, grows = a[i]
            facing, other_grows = b[j]
            rank = self.rank.get(edge + facing)
            # Equal ranks are the same token twice over; the one on the left is merged first.
            if rank is not None and rank < grows and rank <= other_grows:
                return False
            if grows <= other_grows:
                i += 1
                if i == len(a):
                    return True
            else:
                j += 1

    def tokens(self, unit: str) -> list[str]:
        """The tokens of a text, blanks already written as their sign."""
        last: list[str | None] = [None] * len(unit)
        apart = self.apart.get
        for end, (size, token) in self.automaton.iter(unit):
            if last[end] is not None:
                continue
            if end >= size:
                start = end - size
                before = last[start]
                if before is None:  # a character that no token holds stands alone
                    before = last[start] = unit[start]
                known = apart((before, token))
                if known is None:
                    known = self.stay_apart(before, token)
                if not known:
                    continue
            last[end] = token
        out, at = [], len(unit)
        while at:
            out.append(last[at - 1] or unit[at - 1])
            at -= len(out[-1])
        return out[::-1]

    def surface(self, ids: list[int]) -> str:
        """What a run of ids stands for; bytes that form no character become U+FFFD each."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode(errors="replace")

    def unit(self, unit: str) -> tuple[bytes, str]:
        """The ids of a unit as decimals with a comma after each, and what they decode to."""
        single = self.id
        ids: list[int] = []
        for token in self.tokens(unit):
            if token in single:
                ids.append(single[token])
            else:
                ids += [self.byte_id[b] for b in token.encode()]
        return ("%d," * len(ids) % tuple(ids)).encode(), self.surface(ids)

    def encode(self, text: str) -> tuple[bytes, str]:
        """All ids, each as decimals with a comma after it, and the decoded text.

        No token crosses the beginning of a run of blanks or a line break, so a word with the blank
        before it is encoded once and looked up after that. ``decoded`` is put together from what
        the ids of each stand for."""
        if not text:
            return b"", ""
        text = text.replace(SPACE, " ")  # both are written as the sign
        if not self.parts_blanks:
            return self._joined([self.bare.at(SPACE + text.replace(" ", SPACE))])
        ids, decoded = [], []
        for number, line in enumerate(text.split("\n") if self.parts_lines else [text]):
            if number:
                found = self.bare["\n"]
                ids.append(found)
                decoded.append(self.bare.surface("\n"))
            words = line.split(" ")
            if "" in words:  # runs of blanks, or blanks at an end
                units = [self.bare.at(u) for u in _runs((SPACE if not number else "") + line.replace(" ", SPACE))]
                ids += [u[0] for u in units]
                decoded += [u[1] for u in units]
                continue
            if number:
                ids.append(self.bare[words[0]])
                ids += map(self.before_blank.__getitem__, words[1:])
            else:
                ids += map(self.before_blank.__getitem__, words)
            # The decoded form of each word was noted as the same as the word, or apart if not.
            if self.bare.odd or self.before_blank.odd:
                first = self.bare if number else self.before_blank
                decoded.append(first.surface(words[0]))
                decoded += map(self.before_blank.surface, words[1:])
            else:
                decoded.append(line if number else " " + line)
        return self._joined([(b"".join(ids), "".join(decoded))])

    @staticmethod
    def _joined(pairs: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        ids, decoded = pairs[0]
        # The blank put before the text goes again.
        return ids, decoded[1:] if decoded.startswith(" ") else decoded


def _runs(marked: str) -> list[str]:
    """Each run of blank signs with the word after it."""
    return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)


class _Units(dict):
    """Ids of words behind a prefix. ``odd`` has the decoded form of those that it differs for."""

    def __init__(self, model: PieceModel, prefix: str):
        super().__init__()
        self.model, self.prefix, self.odd = model, prefix, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.clear()
        ids, decoded = self.model.unit(self.prefix + word)
        if decoded != self.prefix.replace(SPACE, " ") + word.replace(SPACE, " "):
            self.odd[word] = decoded
        self[word] = ids
        return ids

    def at(self, word: str) -> tuple[bytes, str]:
        return self[word], self.surface(word)

    def surface(self, word: str) -> str:
        return self.odd.get(word) or self.prefix.replace(SPACE, " ") + word.replace(SPACE, " ")


_loaded: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One for each Python worker, kept from task to task."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def encode_pieces(
    docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """Per row: doc_id, n_tokens, and ``ids`` (array) with the text they decode to (``decoded``).

    With ``digests`` the last two are ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256. A null text is empty and has no ids. Rows are independent of each other, so
    repeated rows and null ids need nothing special. ``model`` is the file's path on every machine.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    ends = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches):
        encode = piece_model(model).encode
        for batch in batches:
            n, first, second = [], [], []
            for value in batch.column(1):
                ids, decoded = encode(value.as_py() or "")
                n.append(ids.count(b","))
                if digests:
                    first.append(hashlib.sha256(ids[:-1]).hexdigest())
                    second.append(hashlib.sha256(decoded.encode()).hexdigest())
                else:
                    first.append([int(i) for i in ids[:-1].split(b",")] if ids else [])
                    second.append(decoded)
            arrays = [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(first, pa.string() if digests else pa.list_(pa.int32())),
                pa.array(second, pa.string()),
            ]
            names = ["doc_id", "n_tokens"] + [part.split(" ")[0] for part in ends.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, {ends}")
