"""Token counts by prefix dynamic programming.

For a byte-pair vocabulary whose ids follow the order of its merges, the last token of every prefix of
a word is unique, and two neighbours in an encoding are exactly the pairs that re-encode to
themselves.  So one sweep over a word finds the last token and the number of tokens of each
of its prefixes: the longest token that ends there and may follow the last token of what stands before it.  A text's
prefix counts are its words' counts, summed up; how many tokens any prefix takes and where a budget ends
then need no re-encoding.  The query walks the words' sums and, where the limit can fall inside a word, the counts of that word's prefixes.

Words are told apart and lower-cased here; code points that the library would treat otherwise are found by asking it once for each that occurs, and a text that
holds one is split by the library before it is counted.  Any file whose added tokens take the text as it is, whose words are lower-cased and whose merges end words with a mark will do.

Defined results: a null text counts as empty, with no tokens; ids may be null or repeat; a long text or a long word takes time in proportion to its length; an
empty table gives an empty table.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import MARK, bounded_batches, trim

SPACE_CLASS = r"\x09-\x0D\x20\x85\xA0  -     　"
_counters: dict[tuple[str, int], PrefixCounter] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 0
    for b in range(256):
        letters[b] = chr(b) if b in shown else chr(256 + extra)
        extra += b not in shown
    return letters


class PrefixCounter:
    """Counts for a tokenizer of lower-cased words with an end-of-word mark, read from its JSON file."""

    def __init__(self, path: str, max_words: int = 400_000):
        self.path = path
        self._fine, self._odd = set(), set()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.vocab = vocab
        self.longest = max(len(t.removesuffix(self.end)) for t in vocab)
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        for rank, (a, b) in enumerate(merges):
            made = vocab[a + b]
            left, right = vocab[a], vocab[b]
            self.pair[left, right] = rank
            self.parts.setdefault(made, (left, right))
        self.rank = {made: self.pair[p] for made, p in self.parts.items()}
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE_CLASS}\p{{L}}\p{{N}}]+")
        self.letters = _byte_letters()
        self.max_words = max_words
        self._follows: dict[tuple[int, int], bool] = {}
        self._counts: dict[str, int] = {}  # by byte letters
        self._plain: dict[str, int] = {}  # by word, for the words split here

    def follows(self, left: int, right: int) -> bool:
        """Whether encoding the joined text of the two tokens gives these two tokens back."""
        known = self._follows.get((left, right))
        if known is None:
            if len(self._follows) > 2_000_000:
                self._follows.clear()
            known = self._follows[left, right] = self._stable(left, right)
        return known

    def _stable(self, left: int, right: int) -> bool:
        """Undo the two tokens' merges, latest first; a merge across the border that ranks before the undone one breaks them."""
        limit = 1 << 60
        while True:
            across = self.pair.get((left, right))
            if across is not None and across < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # the later merge is undone first; across the border the left one wins a tie
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 1, self.parts[right][0]

    def word(self, letters: str) -> list[int]:
        """Tokens of each prefix of a word given in byte letters, each closed by the end-of-word mark, from the empty one on."""
        vocab, end, follows = self.vocab, self.end, self.follows
        last, count, closed = [-1], [0], [0]
        for i in range(1, len(letters) + 1):
            for mark, into in (("", True), (end, False)) if end else (("", True),):
                for j in range(max(0, i - self.longest), i):
                    token = vocab.get(letters[j:i] + mark)
                    if token is not None and (j == 0 or follows(last[j], token)):
                        if into:
                            last.append(token)
                            count.append(count[j] + 1)
                        else:
                            closed.append(count[j] + 1)
                        break
            if not end:
                closed.append(count[i])
        return closed

    def whole(self, letters: str) -> int:
        """Tokens of a whole word: as the last of word(), with one sweep for the open tokens only."""
        vocab, follows, longest = self.vocab, self.follows, self.longest
        if letters + self.end in vocab and self._alone(letters + self.end):
            return 1
        last, count = [-1], [0]
        n = len(letters)
        for i in range(1, n):
            for j in range(i - longest if i > longest else 0, i):
                token = vocab.get(letters[j:i])
                if token is not None and (j == 0 or follows(last[j], token)):
                    last.append(token)
                    count.append(count[j] + 1)
                    break
        for j in range(max(0, n - longest), n):
            token = vocab.get(letters[j:n] + self.end)
            if token is not None and (j == 0 or follows(last[j], token)):
                return count[j] + 1
        raise ValueError("the vocabulary lacks a byte")

    def _alone(self, token: str) -> bool:
        return self.vocab[token] in self.rank or len(token.removesuffix(self.end)) == 1

    def spell(self, word: str) -> str:
        return word if word.isascii() and word.isalpha() else "".join([self.letters[b] for b in word.encode()])

    def normalised(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        return text.replace("Σ", "σ").lower()

    @cached_property
    def library(self) -> object:
        """Loaded where a code point beyond ASCII occurs."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def as_the_library(self, c: str) -> bool:
        """Whether a code point is split, composed and lower-cased here as in the library, between letters, digits, marks and its like."""
        text = f"a{c}1{c}{c}!{c}\u0301{c}a\u0323{c}\u0301 {c}"
        return [w for _, _, w in self._own_words(text)[1]] == [w for _, _, w in self._library_words(text)[1]]

    def odd(self, text: str) -> bool:
        if text.isascii():
            return False
        own = set(text)
        for c in own - self._fine - self._odd:
            (self._fine if c.isascii() or self.as_the_library(c) else self._odd).add(c)
        return not self._odd.isdisjoint(own)

    def _own_words(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        text = self.normalised(text)
        return text, [(*m.span(), self.spell(m.group())) for m in self.pattern.finditer(text)]

    def _library_words(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        text = self.library.normalizer.normalize_str(text)
        return text, [(a, b, w) for w, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The normalised text without special tokens, and its words: start, end, byte letters."""
        return self._library_words(text) if self.odd(text) else self._own_words(text)

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, text), in order."""
        at = 0
        for m in self._special.finditer(text) if self._special else ():
            yield False, text[at : m.start()]
            yield True, m.group()
            at = m.end()
        yield False, text[at:]

    def known(self, letters: str) -> int:
        """whole(), remembered for words of usual length."""
        n = self._counts.get(letters)
        if n is None:
            n = self.whole(letters)
            if len(letters) <= 64:
                if len(self._counts) >= self.max_words:
                    self._counts.clear()
                self._counts[letters] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        plain = self._special is None or self._special.search(text) is None
        if plain and not self.odd(text):
            known, spell, total = self._plain, self.spell, 0
            for w in self.pattern.findall(self.normalised(text)):
                n = known.get(w)
                if n is None:
                    n = self.known(spell(w))
                    if len(w) <= 64:
                        if len(known) >= self.max_words:
                            known.clear()
                        known[w] = n
                total += n
            return total
        return sum(1 if special else sum(self.known(w) for _, _, w in self.words(part)[1]) for special, part in self.segments(text))

    def _steps(self, word: str, letters: str) -> list[int]:
        """Tokens of each prefix of a word, by code point, from the first one on."""
        if word[0] == "'" and len(word) == 3:  # a cut contraction splits in another way
            return [sum(self.known(w) for _, _, w in self._own_words(word[:k])[1]) for k in range(1, 4)]
        counts = self.word(letters)
        return [counts[e] for e in np.cumsum([len(c.encode()) for c in word])]

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of each prefix of the normalised text without special tokens, by code point, from the empty prefix on."""
        text, words = self.words(text)
        out = np.zeros(len(text) + 1, np.int64)
        total = at = 0
        for a, b, letters in words:
            out[at + 1 : a + 1] = total
            steps = self._steps(text[a:b], letters)
            out[a + 1 : b + 1] = np.asarray(steps) + total
            total += steps[-1]
            at = b
        out[at + 1 :] = total
        return out

    def fits(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of the normalised text before any prefix of more than `limit` tokens; a special token is taken whole or not at all."""
        total = done = 0
        for special, part in self.segments(text):
            if special:
                total += 1
                if total > limit:
                    return done
                done += len(part)
                continue
            part, words = self.words(part)
            for a, b, letters in words:
                if total + len(letters) > limit:  # no prefix of a word has more tokens than byte letters
                    for k, n in enumerate(self._steps(part[a:b], letters)):
                        if total + n > limit:
                            return done + a + k
                total += self.known(letters)
            done += len(part)
        return done


def counter(path: str, max_words: int = 400_000) -> PrefixCounter:
    """One counter for each Python worker and file."""
    if (path, max_words) not in _counters:
        _counters[path, max_words] = PrefixCounter(path, max_words)
    return _counters[path, max_words]


def token_counts(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", limit: int = 2048) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_tokens, over_limit, cut_at (of a text over the limit, the code points of its normalised form before any prefix over the limit).

    `path` names the tokenizer's file on every executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            n = len(batch)
            size, tokens, cut_at = np.zeros(n, np.int64), np.zeros(n, np.int64), [None] * n
            for i, t in enumerate(batch.column(1)):
                body = t.as_py() or ""
                size[i] = len(body) if body.isascii() else len(body.encode())
                tokens[i] = own.count(body)
                if tokens[i] > limit:
                    cut_at[i] = own.fits(body, limit)
            cols = [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit), pa.array(cut_at, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[f"id{MARK}", "n_bytes", "n_tokens", "over_limit", "cut_at"])
        trim()

    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}"))
    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(count, f"id{MARK} {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_at long").withColumnRenamed(f"id{MARK}", doc_id)
