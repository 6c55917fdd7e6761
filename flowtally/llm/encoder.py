"""Token ids of a word-level BPE vocabulary, worked out once per distinct word."""

import functools
import json

import numpy as np
import regex

# Fixed: characters a byte-level BPE vocabulary writes as themselves.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# A word of these characters is already in normal form and lower-cases letter by letter.
PLAIN = regex.compile("[!-~¡-¬®-įı-ňŊ-ſ]+")


def byte_letters():
    """The letter that stands for each byte value."""
    letters = {b: chr(b) for b in PRINTABLE}
    spare = 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


@functools.lru_cache(maxsize=2)
def encoder(path):
    """The encoder of this worker process; tasks that follow one another share its caches."""
    return WordEncoder(path)


class _Cache(dict):
    """Values of a function, worked out where a key is met first; look-ups of known keys stay in C.

    At its bound it keeps what it holds aside once more, so frequent keys stay.
    """

    def __init__(self, function, bound):
        self.function, self.bound, self.aside = function, bound, {}

    def __missing__(self, key):
        value = self.aside.get(key)
        self[key] = value = self.function(key) if value is None else value
        return value

    def trim(self):
        if len(self) > self.bound:
            self.aside = dict(self)
            self.clear()


class WordEncoder:
    """Ids of ``Tokenizer.encode(text, add_special_tokens=False)`` as little-endian int32 bytes.

    Such a vocabulary never joins across blanks, so each distinct word is
    encoded once and kept. Plain Latin words go straight to the BPE model;
    every other word (other scripts, special tokens, unusual blanks) takes the
    tokenizer's full path. Words and their pieces are kept in
    bounded caches.
    """

    def __init__(self, path, words=500_000, pieces=400_000):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        spec = json.loads(self.full.to_str())
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.pieces = regex.compile(pattern).findall
        self.model = self.full.model
        self.letters = byte_letters()
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)").search
        self.words = _Cache(self._word, words // 2)
        # Words are kept with their ids as well: pieces only serve new ones.
        self.known = _Cache(self._ids, pieces // 2)
        self._piece = self.known.__getitem__

    def _ids(self, piece):
        letters = self.letters
        spelt = "".join([letters[b] for b in piece.encode()])
        return np.array([t.id for t in self.model.tokenize(spelt)], dtype="<i4").tobytes()

    def _word(self, word):
        plain = word.isascii() and word.isprintable() or PLAIN.fullmatch(word)
        if plain and not self.special(word):
            word = word.lower()
            if word.isalpha():
                return self._piece(word)
            if word[-1:] in (".", ",") and word[:-1].isalpha():
                return self._piece(word[:-1]) + self._piece(word[-1])
            return b"".join([self._piece(piece) for piece in self.pieces(word)])
        return np.array(self.full.encode(word, add_special_tokens=False).ids, dtype="<i4").tobytes()

    def __call__(self, text):
        self.words.trim()
        self.known.trim()
        # A special token may hold blanks only if the vocabulary says so; none does here.
        plain = text.replace("\t", " ").replace("\n", " ").replace("\r", " ")
        return b"".join(map(self.words.__getitem__, plain.split(" ")))
