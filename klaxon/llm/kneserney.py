"""Class-conditional Kneser-Ney models over the letters of words, in numpy.

A word is predicted letter by letter, its end included, from up to five letters before.
Each of two classes has its own counts for the longest contexts; both back off to one shared
model of all texts, so that what is rare in both classes tells nothing. The
log-likelihood ratio of a word depends on the word alone, and a text's is the sum of its
words'.

An n-gram is a number of ten bits per letter. Letters are folded into 1022 codes, which
keeps those of most alphabets apart; code 0 pads the start of a word and 1 ends it.
"""

import numpy as np

ORDER = 6
SHARED = 5
BITS = 10
DISCOUNT = 0.75


def fold(word):
    return word.lower()


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER-grams of words, one per letter and end, and the index of each one's word."""
    pad, end = "\x00" * (ORDER - 1), "\x01"
    text = "".join([pad + word + end for word in words])
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    starts = np.cumsum(lengths) - lengths
    codes = 2 + letters.astype(np.uint64) % np.uint64((1 << BITS) - 2)
    ends = starts + lengths - 1
    for at in range(ORDER - 1):
        codes[starts + at] = 0
    codes[ends] = 1
    grams = codes.copy()
    for back in range(1, ORDER):
        grams[back:] |= codes[:-back] << np.uint64(BITS * back)
    predicted = np.ones(len(codes), bool)
    for at in range(ORDER - 1):
        predicted[starts + at] = False
    owner = np.repeat(np.arange(len(words)), lengths - (ORDER - 1))
    return grams[predicted].astype(np.int64), owner


def _tail(grams, order):
    return grams & ((1 << BITS * order) - 1)


def _level(grams, counts):
    """Sorted n-grams with their discounted shares, sorted contexts with what is left over."""
    contexts, place = np.unique(grams >> BITS, return_inverse=True)
    total = np.bincount(place, counts)
    kinds = np.bincount(place)
    share = np.maximum(counts - DISCOUNT, 0) / total[place]
    return grams, share, contexts, DISCOUNT * kinds / total


def _models(grams, counts):
    """Levels SHARED+1..ORDER of one class; below the longest, counts are numbers of letters
    that an n-gram follows."""
    levels = []
    for order in range(ORDER, SHARED, -1):
        levels.append(_level(grams, counts))
        grams, counts = np.unique(_tail(grams, order - 1), return_counts=True)
    return levels[::-1]


def _both(one, other, missing):
    keys = np.union1d(one[0], other[0])
    values = np.full((len(keys), 2), missing, np.float32)
    for column, (own, value) in enumerate((one, other)):
        values[np.searchsorted(keys, own), column] = value
    return keys, values


def shorter(grams, counts):
    """(n-grams, counts) of orders SHARED to 1 from those of order SHARED: below it, counts are
    numbers of letters that an n-gram follows."""
    order = np.argsort(grams)
    tables = [(grams[order], counts[order])]
    for length in range(SHARED - 1, 0, -1):
        tables.append(np.unique(_tail(tables[-1][0], length), return_counts=True))
    return tables


def fit(grams, toxic, ordinary, shared, shared_counts) -> dict:
    """Tables for :func:`ratios` from counts of n-grams by class and of all texts' SHARED-grams."""
    return fit_tables(grams, toxic, ordinary, shorter(shared, shared_counts))


def fit_tables(grams, toxic, ordinary, tables) -> dict:
    """As :func:`fit`, from the shared tables of :func:`shorter`.

    Of a shared table only the contexts matter that end a context of either class, whole: after
    others, both classes give a letter the same probability, whatever that is.
    """
    order = np.argsort(grams)
    grams, toxic, ordinary = grams[order], toxic[order], ordinary[order]
    classes = [_models(grams[n > 0], n[n > 0]) for n in (toxic, ordinary)]
    levels = []
    for one, other in zip(*classes):
        levels.append((_both(one[:2], other[:2], 0.0), _both(one[2:], other[2:], 1.0)))
    # The shared model: interpolated down to letters, then to all codes alike.
    base = []
    for grams, counts in tables:
        order = np.argsort(grams)
        base.append(_level(grams[order], counts[order].astype(np.float64)))
    return {"levels": levels, "base": base[::-1]}


def _found(keys, values, wanted, missing):
    if not len(keys):
        return np.full((len(wanted), *values.shape[1:]), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    found = values[at].astype(np.float64)
    found[~hit] = missing
    return found


def ratios(model: dict, words: list[str]) -> np.ndarray:
    """Log-likelihood of each word in the first class less that in the second."""
    if not words:
        return np.empty(0)
    grams, owner = ngrams(words)
    kinds, back = np.unique(grams, return_inverse=True)
    p = np.full(len(kinds), 1 / (1 << BITS))
    for length, (keys, share, contexts, left) in enumerate(model["base"], 1):
        tail = _tail(kinds, length)
        p = _found(keys, share, tail, 0.0) + _found(contexts, left, tail >> BITS, 1.0) * p
    p = np.stack([p, p], 1)
    for length, (shares, lefts) in enumerate(model["levels"], SHARED + 1):
        tail = _tail(kinds, length)
        p = _found(*shares, tail, 0.0) + _found(*lefts, tail >> BITS, 1.0) * p
    log = np.log(p)
    return np.bincount(owner, (log[:, 0] - log[:, 1])[back], minlength=len(words))
