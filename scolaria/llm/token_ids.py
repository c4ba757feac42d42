"""Token ids of many texts by a tokenizer file, each different chunk of text and each different word encoded once."""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex

from scolaria.llm.shared import kept

#: A chunk is white space and what follows up to the next white space. No pre-token of either tokenizer reaches from a
#: character that is no white space over to white space, so the ids of a text are those of its chunks, one after another.
#: Where letters and signs come in runs, none reaches from an ASCII letter to an ASCII sign either: a chunk ends there too.
SIGNS = string.punctuation
LETTER, SIGN, SPACE = 1, 2, 3
KINDS = np.zeros(256, np.uint8)  # of bytes
for kind, members in ((LETTER, string.ascii_letters), (SIGN, SIGNS), (SPACE, " \n")):
    KINDS[list(members.encode())] = kind
#: What a worker remembers: chunks, and code points of them; then it starts afresh. Some 200 MB, dropped by the next stage.
MAX_CHUNKS, MAX_CHARS = 700_000, 16_000_000
JOINED = 20_000  # keys encoded as one text; with fewer, the library takes longer for each
MARK = "\0"
MARK_IN_VOCABULARY = "Ā"  # how byte-level vocabularies write the byte 0

#: Fixed value: how a byte-level pre-tokenizer parts a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks that no normalizer changes but for their case, and whose case is the same in all libraries. Without "<", which
#: special tokens and the ends of words are written with.
PLAIN = re.compile(r" ?[!-;=-~À-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level vocabularies write for it: printable ones themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(0x100 + n) for n, byte in enumerate(others)}


LETTERS = _byte_letters()
#: Words are joined with these bytes between them, which no plain chunk has; as letters they are " Ā ".
BETWEEN = "\x1f\n\x1f"
AS_LETTERS = np.array([ord({0x1F: " ", 0x0A: MARK_IN_VOCABULARY}.get(byte) or LETTERS.get(byte, chr(byte))) for byte in range(256)], "<u4")

#: The ids of some keys in a row, and the number of ids of each.
Coded = tuple[np.ndarray, np.ndarray]


class _Table:
    """The ids of keys, learned when they are first asked for."""

    def __init__(self, learn: Callable[[list[str]], None]) -> None:
        self.learn = learn
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.unlearned: list[str] = []
        self.ids = np.empty(1 << 16, np.uint32)
        self.first, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.used = self.chars = 0

    def fresh(self) -> list[str]:
        """The keys asked for since the last call; their codes are the latest ones."""
        fresh, self.unlearned = self.unlearned, []
        self.chars += sum(map(len, fresh))
        return fresh

    def put(self, code: Sequence[int], coded: Coded) -> None:
        ids, sizes = coded
        end, keys = self.used + len(ids), len(self.codes)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(2 * len(ids) + self.used, np.uint32)])
        if keys > len(self.first):
            more = np.empty(keys, np.int64)
            self.first, self.size = np.concatenate([self.first, more]), np.concatenate([self.size, more])
        self.ids[self.used : end] = ids
        self.first[code], self.size[code] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used = end

    def of(self, code: np.ndarray) -> Coded:
        """The ids of learned keys, one after another."""
        first, sizes = self.first[code], self.size[code]
        first -= np.cumsum(sizes) - sizes
        places = np.repeat(first, sizes)
        places += np.arange(len(places))
        return self.ids[places], sizes

    def codes_of(self, keys: Sequence[str]) -> np.ndarray:
        """The numbers of keys, a new one for each that is asked for the first time."""
        codes = self.codes
        found = list(map(codes.get, keys))
        new = list(dict.fromkeys(key for key, code in zip(keys, found) if code is None))
        if new:
            codes.update(zip(new, range(len(codes), len(codes) + len(new))))
            self.unlearned += new
            found = [codes[key] if code is None else code for key, code in zip(keys, found)]
        return np.array(found, np.int64)

    def gather(self, keys: Sequence[str], places: np.ndarray) -> Coded:
        """The ids of the keys at these places, one after another."""
        code = self.codes_of(keys)
        if self.unlearned:
            self.learn(self.fresh())
        return self.of(code[places])


def _totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of values of these lengths."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


class ChunkEncoder:
    """Encodes texts as the tokenizers library does with a file, special tokens in a text included.

    Chunks are learned once. A plain one is first parted into its words by the file's own pattern, and these go to the
    file's model without its normalizer, which is most of the library's time; the others go through the whole of it. A
    word alone is a chunk too, so words and chunks share a table, and a chunk of one word is looked up once.
    """

    def __init__(self, path: str, max_chunks: int = MAX_CHUNKS, max_chars: int = MAX_CHARS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_chunks, self.max_chars = max_chunks, max_chars
        self.drops_space = not self.tokenizer.encode(" ", add_special_tokens=False).ids
        self.drops_case = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.mark = f" {MARK} " if self.drops_space else MARK
        own = self.tokenizer.encode(MARK, add_special_tokens=False)
        holders = [token for token in self.tokenizer.get_vocab() if MARK_IN_VOCABULARY in token]
        self.mark_id = own.ids[0] if len(own.ids) == 1 and {token.removesuffix("</w>") for token in holders} == {MARK_IN_VOCABULARY} else None
        file = json.loads(self.tokenizer.to_str())
        self.special = re.compile("|".join(re.escape(token["content"]) for token in file["added_tokens"]) or r"(?!)", re.I)
        self.pattern = self._pattern_of(file) if self.mark_id is not None else None
        if self.pattern and self.pattern.findall(f"ab{SIGNS}") != ["ab", SIGNS]:  # letters and signs come in runs
            self.pattern = None
        if self.pattern:
            bare = file | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
            self.model = Tokenizer.from_str(json.dumps(bare))
        self.chunks = _Table(self._learn)

    @staticmethod
    def _pattern_of(file: dict) -> regex.Pattern | None:
        """The pattern that parts a text into pre-tokens, if the file is of a known kind."""
        steps = file["pre_tokenizer"] or {}
        steps = steps.get("pretokenizers", [steps])
        normal = (file.get("normalizer") or {}).get("normalizers", [file["normalizer"]] if file.get("normalizer") else [])
        last = steps[-1]
        if last.get("type") != "ByteLevel" or last.get("add_prefix_space") or {step["type"] for step in normal} - {"NFC", "Replace", "Lowercase"}:
            return None
        if len(steps) == 1 and last.get("use_regex", True):
            return regex.compile(BYTE_LEVEL)
        if len(steps) == 2 and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not last["use_regex"]:
            return regex.compile(steps[0]["pattern"]["Regex"])
        return None

    def _parted(self, encode: Callable[[list[str]], list], keys: list[str], join: Callable[[list[str]], str]) -> Coded:
        """The ids of keys; many are encoded as one text, joined with a mark between them. No token but its own holds the mark."""
        out, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for first in range(0, len(keys), JOINED):
            ids = np.array(encode([join(keys[first : first + JOINED])])[0].ids, np.uint32)
            marks = ids == self.mark_id
            out.append(ids[~marks])
            sizes.append(np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1)
        return np.concatenate(out), np.concatenate(sizes)

    @staticmethod
    def _as_letters(words: list[str]) -> str:
        return AS_LETTERS[np.frombuffer(BETWEEN.join(words).encode(), np.uint8)].tobytes().decode("utf-32-le")

    def _learn(self, chunks: list[str]) -> None:
        table, first = self.chunks, len(self.chunks.codes) - len(chunks)
        words: list[str] = []
        parts: list[str] = []
        counts: list[int] = []
        others: list[str] = []
        of_words: list[int] = []
        of_parted: list[int] = []
        of_others: list[int] = []
        plain = PLAIN.fullmatch
        for code, chunk in enumerate(chunks, first):
            if self.pattern is None or plain(chunk) is None:
                others.append(chunk)
                of_others.append(code)
                continue
            if self.drops_case:
                chunk = chunk.lower()
            stem = chunk.rstrip(SIGNS)
            if not (stem.isalpha() or stem[1:].isalpha() and stem[0] == " "):
                found = self.pattern.findall(chunk)
            elif len(stem) < len(chunk):
                found = (stem, chunk[len(stem) :])
            else:
                found = (chunk,)
            if len(found) == 1:
                words.append(found[0])
                of_words.append(code)
            else:
                parts += found
                counts.append(len(found))
                of_parted.append(code)
        of_parts = table.codes_of(parts)
        more = table.fresh()  # words that are no chunk yet
        of_words += range(len(table.codes) - len(more), len(table.codes))
        words += more
        if words:
            table.put(of_words, self._parted(lambda texts: self.model.encode_batch_fast(texts, add_special_tokens=False), words, self._as_letters))
        self._learn_others(of_others, others)
        ids, sizes = table.of(of_parts)
        table.put(of_parted, (ids, _totals(sizes, np.array(counts, np.int64))))

    def _learn_others(self, codes: list[int], chunks: list[str]) -> None:
        """Chunks by the whole of the library.

        Those that hold the mark or a special token, begin with an apostrophe or end in white space are encoded alone:
        there the mark could part or join pre-tokens.
        """
        whole = lambda texts: self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        joined: list[tuple[int, str]] = []
        for code, chunk in zip(codes, chunks):
            if self.mark_id is None or not chunk or MARK in chunk or chunk[0] == "'" or chunk[-1].isspace() or self.special.search(chunk) is not None:
                ids = np.array(whole([chunk])[0].ids, np.uint32)
                self.chunks.put([code], (ids, np.array([len(ids)], np.int64)))
            else:
                joined.append((code, chunk))
        self.chunks.put([code for code, _ in joined], self._parted(whole, [chunk for _, chunk in joined], self.mark.join))

    def _chunks(self, texts: Sequence[str | None]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The chunks of all texts in a row, and how many each text has.

        A tokenizer that drops white space needs none in its chunks, and one that drops case no capitals (A-Z only). A text
        with a special token, which is told by its case, is a chunk whole.
        """
        whole = [i for i, text in enumerate(texts) if text and "<" in text and self.special.search(text)]
        parts = [(text or "").encode() for text in texts]
        if self.drops_case:
            kept_case = {i: parts[i] for i in whole}
            parts = [kept_case.get(i) or part.lower() for i, part in enumerate(parts)]
        bounds = np.concatenate([[0], np.cumsum([len(part) for part in parts], dtype=np.int64)])
        data = np.frombuffer(b"".join(parts), np.uint8)
        kinds = KINDS[data]
        for i in whole:
            kinds[bounds[i] : bounds[i + 1]] = 0
        space = kinds == SPACE
        begins = np.zeros(len(data) + 1, bool)  # of a chunk; with a place for empty texts at the end
        begins[1:-1] = space[:-1] & ~space[1:] if self.drops_space else ~space[:-1] & space[1:]
        if self.pattern:
            begins[1:-1] |= (kinds[:-1] == LETTER) & (kinds[1:] == SIGN)
        begins[bounds] = True
        begins = begins[:-1]
        if self.drops_space:
            begins &= ~space
        places = np.flatnonzero(begins)
        counts = np.diff(np.searchsorted(places, bounds))
        if self.drops_space:
            places, data = places - np.cumsum(space)[places], data[~space]
        ends = np.append(places, len(data))
        return pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode(), counts

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start, with the end. A null text is an empty one."""
        if len(self.chunks.codes) > self.max_chunks or self.chunks.chars > self.max_chars:
            self.chunks.clear()
        chunks, counts = self._chunks(texts)
        ids, sizes = self.chunks.gather(chunks.dictionary.to_numpy(zero_copy_only=False).tolist(), chunks.indices.to_numpy())
        return ids, np.concatenate([[0], np.cumsum(_totals(sizes, counts))])


def encoder_of(path: str) -> ChunkEncoder:
    """This process's encoder for a file: the tasks that one Python worker runs share what it has learned."""
    return kept(f"tokens of {path}", lambda: ChunkEncoder(path))
