"""Token ids of whole texts by a public tokenizer, at the cost of their distinct words.

The tokenizers library cuts a text into pieces before it merges inside each piece. No piece
reaches across a single space or line break that stands between two visible characters, so
a batch of texts is cut there and each distinct part encoded once. ``WORD`` suits a
vocabulary that drops white space, ``BYTE`` one that keeps a space with the word that follows.
Marks that end a part are a piece of their own, and what is left, if it is letters alone, is
one piece that goes straight to the library's merges. Any other part goes through the whole
tokenizer. A text with other white space next to a cut, or with the string of a special
token, is encoded as a whole. Tests hold the ids against those of the library on whole texts.

Cutting, finding the distinct parts and putting ids together happen in Arrow and NumPy.
"""

import os

# Each task is one of many on its machine: threads of the library would oversubscribe it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from klaxon.llm.memory import remembered

# Bytes of text that are encoded at once; a longer text goes alone. More spare more words.
BYTES_AT_ONCE = 8 << 20
# Words without their marks that a worker remembers, of 200 bytes each or so.
WORDS_KEPT = 250_000

WORD, BYTE = "word", "byte"

# Both vocabularies cut between letters and these. The apostrophe is not among them, as it
# may begin a contraction.
_MARKS = ".,;:!?|%*#$&"
# Letters below this have no other composed form, and the same lower-case form whatever
# stands beside them.
_PLAIN = "ʰ"


def _byte_letters():
    """The letter that stands for each byte in vocabularies of bytes: itself if it can be seen."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {byte: chr(byte if byte in seen else next(hidden)) for byte in range(256)}


_LETTERS = _byte_letters()
_SPACE = _LETTERS[32]


class Recent:
    """What ``make`` gives for keys, remembered for those in use: about ``most`` of them besides those
    of the last call."""

    def __init__(self, make, most):
        self.make, self.most = make, most
        self.newer, self.older = {}, {}

    def of(self, keys):
        if len(self.newer) >= self.most // 2:
            # Keys in use come back from the older half, the rest goes with it.
            self.newer, self.older = {}, self.newer
        newer, older, make = self.newer, self.older.get, self.make
        found = list(map(newer.get, keys))
        for at, one in enumerate(found):
            if one is None:
                key = keys[at]
                one = older(key)
                found[at] = newer[key] = make(key) if one is None else one
        return found


class Runs:
    """Runs of ids one behind the other."""

    def __init__(self, ids, lengths):
        self.ids, self.lengths = ids, lengths
        self.ends = np.cumsum(lengths)

    @classmethod
    def of(cls, packed):
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        return cls(np.frombuffer(b"".join(packed), np.uint32), lengths)

    def take(self, which):
        """The runs of these numbers, in this order."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        place = np.repeat(self.ends[which] - ends, lengths)
        place += np.arange(len(place))
        return Runs(self.ids[place], lengths)


def _texts(array):
    """Strings of an Arrow array as a list, by NumPy, which is several times faster."""
    return array.to_numpy(zero_copy_only=False).tolist()


def _packed(ids):
    return array("I", ids).tobytes()


class Encoder:
    """Ids of texts by the tokenizer of a file."""

    def __init__(self, path, kind, words_kept=WORDS_KEPT):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = kind
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.words = Recent(self._word, words_kept)

    def whole(self, text):
        """Ids of one text as the library gives them."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece):
        """Ids of what the library's own cutting leaves in one piece."""
        if not (piece.isascii() and piece.isalpha()):
            piece = piece.encode().decode("latin-1").translate(_LETTERS)
        return _packed([token.id for token in self.model.tokenize(piece)])

    def _word(self, word):
        """Ids of a part without its marks if it is letters alone, else nothing."""
        if word.isascii() and word.isalpha():
            word = _SPACE + word if self.kind == BYTE else word.lower()
            return array("I", [token.id for token in self.model.tokenize(word)]).tobytes()
        body = word[1:] if self.kind == BYTE and word[:1] == "\n" else word
        # A dotted I becomes two characters in lower case, of which one is no letter.
        if body.isalpha() and max(body) < _PLAIN and body.lower().isalpha():
            if self.kind == WORD:
                return self._piece(body.lower())
            if body is word:
                return self._piece(" " + body)
            return self._piece("\n") + self._piece(body)
        return b""

    def _other(self, part):
        """Ids of a part that is not letters and marks; None if it has to be seen with its
        neighbours."""
        if self.kind == WORD:
            return self.whole(part) if part else b""
        line = part[:1] == "\n"
        body = part[1:] if line else part
        if not body or body[0].isspace() or body[-1].isspace():
            return None
        return self.whole(part if line else " " + part)

    def _parts(self, parts):
        """Ids of distinct parts, and which of them have to be seen with their neighbours."""
        trimmed = pc.utf8_rtrim(parts, characters=_MARKS)
        cut = pc.subtract(pc.utf8_length(parts), pc.utf8_length(trimmed)).to_numpy()
        if self.kind == WORD:
            # The vocabulary has no capitals; other letters wait for their own test.
            trimmed = pc.ascii_lower(trimmed)
        stems = trimmed.dictionary_encode()
        found = self.words.of(_texts(stems.dictionary))
        plain = np.fromiter(map(bool, found), bool, len(found))
        stem = stems.indices.to_numpy().astype(np.int64)
        plain = plain[stem]
        # A part is one run and that of its marks, here as yet none.
        tail = np.full(len(parts), len(found))
        found.append(b"")
        marked = np.flatnonzero(plain & (cut > 0))
        texts = [part[-n:] for part, n in zip(_texts(parts.take(marked)), cut[marked].tolist())]
        marks = pa.array(texts, pa.string()).dictionary_encode()
        tail[marked] = len(found) + marks.indices.to_numpy()
        found += map(self._piece, _texts(marks.dictionary))
        apart = np.zeros(len(parts), bool)
        odd = np.flatnonzero(~plain)
        stem[odd] = len(found) + np.arange(len(odd))
        for at, part in zip(odd, _texts(parts.take(odd))):
            ids = self._other(part)
            apart[at] = ids is None
            found.append(ids or b"")
        taken = Runs.of(found).take(np.stack([stem, tail], 1).ravel())
        return Runs(taken.ids, taken.lengths.reshape(-1, 2).sum(1)), apart

    def encode(self, texts):
        """(ids, starts) of an Arrow array of strings: those of text i are ids[starts[i] : starts[i
        + 1]], as uint32. Null counts as empty."""
        texts = texts.fill_null("")
        alone = np.zeros(len(texts), bool)
        for special in self.special:
            alone |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(texts, "\n", " " if self.kind == WORD else " \n")
        lists = pc.split_pattern(cut, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds -= bounds[0]
        runs, apart = self._parts(words.dictionary)
        which = words.indices.to_numpy().astype(np.int64)
        if self.kind == BYTE:
            # A text's first part has no space before it.
            firsts = _texts(pc.list_element(lists, 0))
            which[bounds[:-1]] = len(runs.lengths) + np.arange(len(firsts))
            blank = [first[-1:].isspace() for first in firsts]
            own = Runs.of([b"" if no or not first else self.whole(first) for first, no in zip(firsts, blank)])
            runs = Runs(np.concatenate([runs.ids, own.ids]), np.concatenate([runs.lengths, own.lengths]))
            apart = np.concatenate([apart, blank])
        sums = np.concatenate([[0], np.cumsum(apart[which])])
        alone |= sums[bounds[1:]] > sums[bounds[:-1]]
        taken = runs.take(which)
        starts = np.concatenate([[0], taken.ends])[bounds]
        if not alone.any():
            return taken.ids, starts
        pieces = [taken.ids[a:b] for a, b in zip(starts[:-1], starts[1:])]
        for at in np.flatnonzero(alone):
            pieces[at] = np.frombuffer(self.whole(texts[at].as_py()), np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(one) for one in pieces])])
        return np.concatenate(pieces), starts


def pieces(batches, column, most=BYTES_AT_ONCE):
    """Rows of batches, divided and put together so that each piece has about ``most`` bytes of text
    in a column."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = 0
        for at, length in enumerate(lengths):
            if size and size + length > most:
                yield _joined([*held, batch.slice(start, at - start)])
                held, size, start = [], 0, at
            size += length
        held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(batches):
    whole = [batch for batch in batches if len(batch)] or batches[:1]
    return whole[0] if len(whole) == 1 else pa.concat_batches(whole)


def encoder(path, kind, words_kept=WORDS_KEPT):
    """The encoder of this worker process for a file."""
    return remembered((path, kind), lambda: Encoder(path, kind, words_kept))
