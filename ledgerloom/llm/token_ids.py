"""Token ids of whole texts through the tokenizers library, with the ids of words kept between texts.

A single space or line feed between two other characters is a place where both vocabularies start anew, so a text
is the row of its words (with the space or line feed before them), and a word's ids are asked of the library once
per worker process. Texts with any other white space are handed to the library as a whole.

Where the space before a word does not count, many texts are split by Arrow and each different word is looked up once; a new word is put together from its runs of letters and of other signs, which the library's pre-tokenizer parts as well.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm.common import kept_in_worker, travels_by_value

MOST_WORDS = 800_000
_TOGETHER = 4_000
_CHARS = 8_000_000  # texts that are split at once
_WORDS = 1 << 18  # words whose ids are put in place at once
_MARK = "\x01"
_LETTERS = "a-zªµºÀ-ÖØ-öø-ÿ"  # of Latin-1, all letters to the library too; its texts need no composing
_CUT = "\x02"
_SIGNS = [f"{_CUT},", f"{_CUT}."]
# ends no run of signs: empty, or a letter or digit at the end, that is one to every version of Unicode
_CLOSED = "^$|[0-9a-zªµºÀ-ÖØ-öø-\u012f\u0131-\u024f\u03b1-\u03c9\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]$"
_LETTERED = re.compile(f"[{_LETTERS}]+")
_RUNS = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}]+")
_PARTED = re.compile(r"[^\u0100-\U0010ffff']+")  # an apostrophe takes letters with it


class TokenIds:
    """encode() gives the ids of texts as little-endian 32-bit bytes."""

    def __init__(self, file: str, spaces_count: bool, most_words: int = MOST_WORDS):
        """spaces_count: whether a word's ids depend on the space before it. most_words: kept words; beyond that the latest are forgotten and asked anew."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.spaces_count = spaces_count
        self.most_words = most_words
        self.words: dict[str, bytes] = {}
        # many words are asked as one text; an id that only stands where a word begins, or between two words, parts them again
        line = self.ask(["\n"])[0] if spaces_count else self.ask([_MARK])[0]
        self.mark = int.from_bytes(line, "little")
        size = 1 + max(self.library.get_vocab().values())
        self.begins = np.zeros(size, bool)
        self.marks = dict(zip(",.", self.ask([",", "."]), strict=True))
        if spaces_count:
            space = self.library.id_to_token(int.from_bytes(self.ask([" "])[0], "little"))
            self.begins[[i for token, i in self.library.get_vocab().items() if token.startswith(space)]] = True
        else:
            self.forget(0)
            # what the model sees of a letter; None if letters are not kept together
            letters = [chr(i) for i in range(256) if re.fullmatch(f"[{_LETTERS}]", chr(i))]
            seen = [self._seen(c) for c in letters]
            self.letters = dict(zip(map(ord, letters), seen, strict=True)) if self._seen("".join(letters)) == "".join(seen) else None

    def _seen(self, text: str) -> str:
        """What the model is given for a text; a line feed between its units."""
        return "\n".join(unit for unit, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)))

    def ask(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.ask([text])[0], "<u4")

    def _spaced(self, words: list[str]) -> list[bytes]:
        """The ids of words that follow a space."""
        if not self.spaces_count:
            ids = self._ids(f" {_MARK} ".join(["", *words]))
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)) * 4
            begins = ends + 4
        else:
            ids = self._ids(" " + " ".join(words))
            begins = ends = np.append(np.flatnonzero(self.begins[ids]), len(ids)) * 4
        return self._parted(ids, begins, ends, words, " " if self.spaces_count else "")

    def _lined(self, words: list[str]) -> list[bytes]:
        """The ids of words that follow a line feed, with the line feed's."""
        ids = self._ids("".join(words))
        ends = np.append(np.flatnonzero(ids == self.mark), len(ids)) * 4
        return self._parted(ids, ends, ends, words, "")

    def _parted(self, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, words: list[str], before: str) -> list[bytes]:
        if len(ends) != len(words) + 1:
            return self.ask([before + w for w in words])
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(begins.tolist(), ends[1:].tolist(), strict=False)]

    def learn(self, new: Iterable[str]) -> None:
        """Keep the ids of words; what is not a plain word is left out."""
        plain = [w for w in new if _plain(w)]
        # a comma or full stop behind an ASCII letter is a unit of its own
        ended = {w: (w[:-1], self.marks[w[-1]]) for w in plain if w[-1] in self.marks and len(w) > 1 and w[-2].isascii() and w[-2].isalpha()}
        rest = {w for w in plain if w not in ended} | {w for w, _ in ended.values() if w not in self.words}
        for lined, ask in ((False, self._spaced), (True, self._lined)):
            kind = [w for w in rest if (w[0] == "\n") == lined]
            for i in range(0, len(kind), _TOGETHER):
                part = kind[i : i + _TOGETHER]
                self.words.update(zip(part, ask(part), strict=True))
        for w, (front, mark) in ended.items():
            self.words[w] = self.words[front] + mark

    def forget(self, most: int) -> None:
        """Keep the first words only, at least the empty one, that stands between two spaces and has no ids, and the signs."""
        first = [b"", *(self.marks[sign[1:]] for sign in _SIGNS)]
        if most <= len(first):
            self.known = {w: i for i, w in enumerate(["", *_SIGNS])}
            self.ids, self.ends = np.frombuffer(b"".join(first), "<u4"), np.cumsum([0, *(len(x) // 4 for x in first)])
        else:
            self.known, self.ends = dict(islice(self.known.items(), most)), self.ends[: most + 1].copy()
            self.ids = self.ids[: self.ends[-1]].copy()

    def look_up(self, words: list[str]) -> np.ndarray:
        """The places of words among the known ones, -1 for others."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def learn_parts(self, new: list[str]) -> None:
        """Keep the ids of new words without upper-case ASCII letters; what is not a plain word is left out."""
        alone, rest, joined, parts, many = [], [], [], [], []
        for w in dict.fromkeys(new):
            if w.isascii() and w.isalpha():
                alone.append(w)
            elif _plain(w):
                runs = _RUNS.findall(w) if _PARTED.fullmatch(w) else [w]
                if len(runs) > 1:
                    joined.append(w)
                    parts += runs
                    many.append(len(runs))
                else:
                    (alone if _LETTERED.fullmatch(w) else rest).append(w)
        own = {*alone, *rest}
        for p in dict.fromkeys(parts):
            if p not in self.known and p not in own:
                (alone if _LETTERED.fullmatch(p) else rest).append(p)
        if self.letters:
            # a run of letters is one unit of the pre-tokenizer and goes to the model at once
            model, number, flat, ends = self.library.model, attrgetter("id"), array("I"), []
            for p in alone:
                flat.extend(map(number, model.tokenize(p if p.isascii() else p.translate(self.letters))))
                ends.append(len(flat))
            self._keep(alone, np.frombuffer(flat.tobytes(), "<u4"), np.array(ends, np.int64))
        else:
            rest = alone + rest
        found = [ids for i in range(0, len(rest), _TOGETHER) for ids in self._spaced(rest[i : i + _TOGETHER])]
        self._keep(rest, np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(x) // 4 for x in found], dtype=np.int64))
        ids, ends = self._put(self.look_up(parts))
        self._keep(joined, ids, ends[np.cumsum(many, dtype=np.int64)])

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        if not words:
            return
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.ids = np.concatenate((self.ids, ids))
        self.ends = np.concatenate((self.ends, self.ends[-1] + ends))

    def _put(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one behind the other and, from 0, where each ends; none for place -1."""
        many = np.where(at < 0, 0, np.diff(self.ends).take(at, mode="clip"))
        to = np.append(0, np.cumsum(many))
        ids = np.empty(to[-1], "<u4")
        for i in range(0, len(at), _WORDS):
            some = slice(i, min(i + _WORDS, len(at)))
            first, last = to[some.start], to[some.stop]
            place = np.repeat(self.ends.take(at[some], mode="clip") - to[some], many[some])
            place += np.arange(first, last)
            self.ids.take(place, out=ids[first:last], mode="clip")
        return ids, to

    def _split(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most_words:
            # the words met first are the frequent ones
            self.forget(self.most_words * 3 // 4)
        column = pc.replace_substring(pc.ascii_lower(pa.array(texts, pa.large_string())), "\n", " ")
        marked = [k for k, text in enumerate(texts) if _CUT in text]
        for sign in _SIGNS:  # a comma or full stop at the end of a word is a word for itself
            column = pc.replace_substring(column, sign[1:] + " ", sign + " ")
        rows = pc.split_pattern(pc.replace_substring(column, _CUT, f" {_CUT}"), " ")
        borders = np.append(0, np.cumsum(pc.list_value_length(rows).to_numpy()))
        words = rows.flatten().dictionary_encode()
        kinds, different = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        # but not behind another sign, with which it is one unit
        sign = pc.is_in(words.dictionary, value_set=pa.array(_SIGNS, words.dictionary.type)).to_numpy(zero_copy_only=False)
        loose = pc.invert(pc.match_substring_regex(words.dictionary, _CLOSED)).to_numpy(zero_copy_only=False)
        behind = np.flatnonzero(sign.take(kinds[1:]) & loose.take(kinds[:-1])) + 1
        behind = behind[~np.isin(behind, borders)]
        pairs, pair = np.unique(kinds[behind - 1].astype(np.int64) * len(different) + kinds[behind], return_inverse=True)
        first, second = np.divmod(pairs, max(len(different), 1))
        different += [different[a] + different[b][1:] for a, b in zip(first.tolist(), second.tolist(), strict=True)]
        kinds = kinds.astype(np.int64)
        kinds[behind - 1] = len(words.dictionary) + pair
        places = self.look_up(different)
        new = np.flatnonzero(places < 0).tolist()
        if new:
            new_words = [different[k] for k in new]
            self.learn_parts(new_words)
            places[new] = self.look_up(new_words)
        at = places.take(kinds)
        at[behind] = 0
        ids, to = self._put(at)
        raw, cuts = ids.tobytes(), (4 * to[borders]).tolist()
        found = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        whole = np.unique(np.append(np.searchsorted(borders, np.flatnonzero(at < 0), "right") - 1, marked)).astype(int).tolist()
        for k, own in zip(whole, self.ask([texts[k] for k in whole]), strict=True):
            found[k] = own
        return found

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        if not self.spaces_count:
            return [ids for some in _portions(texts) for ids in self._split(some)]
        if len(self.words) > self.most_words:
            # the words met first are the frequent ones
            self.words = dict(islice(self.words.items(), self.most_words * 3 // 4))
        rows = [("\n" + t).replace("\n", " \n").split(" ")[1:] for t in texts]  # the first word as if it followed a line feed
        get = self.words.get
        found = [list(map(get, row)) for row in rows]
        new = {w for row, ids in zip(rows, found, strict=True) if None in ids for w, i in zip(row, ids, strict=True) if i is None}
        self.learn(new)
        whole = []
        for k, (row, ids) in enumerate(zip(rows, found, strict=True)):
            if None in ids:
                ids = [get(w) if i is None else i for w, i in zip(row, ids, strict=True)]
            if None in ids:
                whole.append(k)
                found[k] = b""
            else:
                found[k] = b"".join(ids)[4 * self.spaces_count :]
        for k, ids in zip(whole, self.ask([texts[k] for k in whole]), strict=True):
            found[k] = ids
        return found


def _plain(word: str) -> bool:
    """No other white space than a line feed before it, no sign of a special token and not the mark."""
    return len(p := word.split()) == 1 and word in (p[0], "\n" + p[0]) and "<|" not in word and _MARK not in word


def _portions(texts: list[str]) -> Iterator[list[str]]:
    some, chars = [], 0
    for text in texts:
        some.append(text)
        chars += len(text)
        if chars >= _CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def token_ids(file: str, spaces_count: bool) -> TokenIds:
    """One per worker process and vocabulary."""
    return kept_in_worker(("token ids", file, spaces_count), lambda: TokenIds(file, spaces_count))


travels_by_value(__name__)
