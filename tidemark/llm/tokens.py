"""Batch encoding with a public tokenizer: word-sized chunks that a worker has met lately are not encoded again."""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._base import kept

#: Chunks of a generation; a worker remembers the last two of them, about 200 bytes a chunk. Longer chunks aren't remembered.
MEMO_CHUNKS, CHUNK_CHARS = 320_000, 64
#: Letters of Latin-1, then ASCII signs: both tokenizers part such a chunk exactly there. An apostrophe may begin a contraction.
_PLAIN = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
_LETTERS, _SIGNS = ("".join(chr(i) for i in range(33, 256) if re.fullmatch(x, chr(i))) for x in ("[A-Za-zÀ-ÖØ-öø-ÿ]", "[!-&(-/:-@\\[-`{-~]"))
#: Words that the tokenizer gets as one text.
WORDS = 64
#: What is left of eight bytes when only so many count.
_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def tokenizer_path(name_or_path: str) -> str:
    """A path as given, or the place of a public tokenizer file of that name."""
    if os.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def _characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


_CHARACTERS = _characters()
#: The same, but a space stays one.
_TABLE = "".join(_CHARACTERS[:32]) + " " + "".join(_CHARACTERS[33:])


class _Memo(dict):
    """chunk -> number of a generation; an unknown chunk is taken over from the generation before, or waits to be encoded."""

    def __init__(self, owner, prefix, old=None):
        self.owner, self.prefix, self.old = owner, prefix, {} if old is None else old
        if old is not None:
            old.old = {}

    def __missing__(self, chunk):
        n = self.owner.number(self.prefix + chunk, self.old.get(chunk))
        if len(chunk) <= CHUNK_CHARS:
            self[chunk] = n
        return n


def _strings(found: pa.Array) -> list[str]:
    return found.to_numpy(zero_copy_only=False).tolist()


def _parts(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of large strings or binaries that isn't a slice."""
    _, offsets, data = found.buffers()
    return np.frombuffer(offsets, np.int64, len(found) + 1) if len(found) else np.zeros(1, np.int64), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def _binaries(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids as binaries; ends: where in ids each of them ends."""
    offsets = 4 * np.append(0, ends).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, np.uint32))])


def _hashes(texts: pa.Array) -> np.ndarray:
    """64 bits of each text's length and first 4 * CHUNK_CHARS bytes, taken eight at a time."""
    offsets, data = _parts(texts)
    size, h = np.diff(offsets), np.diff(offsets).astype(np.uint64)
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    for at in range(0, 4 * CHUNK_CHARS, 8):
        some = np.flatnonzero(size > at)
        if not len(some):
            break
        x = h[some] ^ (eight[offsets[some] + at] & _BYTES[np.minimum(size[some] - at, 8)])
        x *= np.uint64(0x9E3779B97F4A7C15)
        h[some] = x ^ x >> np.uint64(29)
    return h


class _Words:
    """Texts and their ids, found by sorted hashes of the texts and told apart by the texts themselves."""

    def __init__(self):
        self.texts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met = np.zeros(0, bool)  # in this generation
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __iter__(self):
        return iter(_strings(self.texts))

    def __contains__(self, text: str) -> bool:
        return text in _strings(self.texts)

    def turn(self):
        """A new generation; texts that were not met in the one so far are forgotten."""
        keep = self.met[self.places]
        self.keys, self.places = self.keys[keep], (np.cumsum(self.met, dtype=np.int32) - 1)[self.places[keep]]
        kept = pa.array(self.met)
        self.texts, self.ids = self.texts.filter(kept), self.ids.filter(kept)
        self.met = np.zeros(len(self.texts), bool)

    def ids_of(self, texts: pa.Array, encode) -> pa.Array:
        """The ids of different texts; encode gives those of unknown ones, by their places in ascending order."""
        h = _hashes(texts)
        order = np.argsort(h)
        own = h[order]
        at = np.searchsorted(self.keys, own)
        hit = self.keys.take(at, mode="clip") == own if len(self.keys) else np.zeros(len(own), bool)
        if hit.any():  # the same text?
            hit[hit] = pc.equal(self.texts.take(pa.array(self.places[at[hit]])), texts.take(pa.array(order[hit]))).to_numpy(zero_copy_only=False)
        known, by_hash, found = order[hit], order[~hit], self.places[at[hit]]
        self.met[found] = True
        fresh = np.sort(by_hash)
        new = encode(fresh)
        ids = pa.concat_arrays([self.ids.take(pa.array(found)), new])
        where = np.empty(len(order), np.int64)
        where[known], where[fresh] = np.arange(len(known)), np.arange(len(known), len(order))
        some = texts.take(pa.array(fresh))
        short = np.asarray(pc.less_equal(pc.utf8_length(some), CHUNK_CHARS))
        if short.any():  # these are remembered
            count, turn = len(self.texts), np.searchsorted(fresh, by_hash)
            self.texts, self.ids = pa.concat_arrays([self.texts, some.filter(pa.array(short))]), pa.concat_arrays([self.ids, new.filter(pa.array(short))])
            self.met = np.append(self.met, np.ones(len(self.texts) - count, bool))
            kept, place = short[turn], (count - 1 + np.cumsum(short))[turn]
            self.keys, self.places = (np.insert(x, at[~hit][kept], y[kept]) for x, y in ((self.keys, own[~hit]), (self.places, place)))
        return ids.take(pa.array(where))


class BatchEncoder:
    """encode(texts) gives all ids in one array and the number of ids of each text.

    Both public tokenizers split a text into words before anything else. For the byte-level one a single space or
    line feed between two characters that aren't white space always begins a word; for the word-level one every
    space or line feed lies between words. Chunks cut there encode as they do within their text; a text with
    other runs of white space is encoded whole where that matters. Chunks are remembered in two generations: the
    older one is dropped when the newer is full, and what is met again moves to the newer one.

    For the word-level one the equal chunks of all texts given at once are looked up once, letters apart from the signs
    after them, and all of them at once.
    """

    def __init__(self, name_or_path: str, memo: int = MEMO_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = tokenizer_path(name_or_path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words_only, self.token_bytes = bool(spec.get("normalizer")), None
        self.model = self.tokenizer.model  # a character of its texts stands for a byte
        self.as_bytes = {b: "".join(_CHARACTERS[x] for x in chr(b).encode()) for b in range(128, 256)}
        if (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel":  # a character of a token stands for a byte
            sizes = self.tokenizer.get_vocab()
            self.token_bytes = np.zeros(max(sizes.values()) + 1, np.int64)
            self.token_bytes[list(sizes.values())] = [len(t) for t in sizes]
        if self.words_only:  # for words as the model gets them; a word's last id is that of a token with the suffix
            from tokenizers import pre_tokenizers

            vocabulary, suffix = self.tokenizer.get_vocab(), spec["model"]["end_of_word_suffix"]
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.words = Tokenizer(self.model)
            self.words.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.run = re.compile(r"\s\s")
        self.most = memo
        self.bare, self.spaced, self.ids = _Words() if self.words_only else None, None, ()
        if not self.words_only:
            self._turn()

    def _turn(self):
        """A new generation; the one so far becomes the older one."""
        self.old = self.ids
        self.flat, self.at, self.size = array("I"), array("q"), array("i")
        self.ids = (self.flat, self.at, self.size)
        self.waiting, self.places = [], []
        self.bare, self.spaced = _Memo(self, "", self.bare), _Memo(self, " ", self.spaced)

    def number(self, chunk: str, before: int | None = None) -> int:
        """The next number, for a chunk that has the number `before` in the older generation, or waits."""
        n = len(self.at)
        if before is None:
            self.at.append(0)
            self.size.append(0)
            self.waiting.append(chunk)
            self.places.append(n)
        else:
            flat, at, size = self.old
            self.at.append(len(self.flat))
            self.size.append(size[before])
            self.flat.extend(flat[at[before] : at[before] + size[before]])
        return n

    def _flush_plain(self) -> list[int]:
        """Words of letters go to the tokenizer's model at once, as it gets them after normalizing and splitting a text;
        returns which chunks are left."""
        rest, flat, at, size, places = [], self.flat, self.at, self.size, self.places
        tokenize, ends = self.model.tokenize, {}  # the ids of signs
        known = self.spaced
        for k, chunk in enumerate(self.waiting):
            plain = _PLAIN.fullmatch(chunk)
            if plain is None:
                rest.append(k)
                continue
            space, word, signs = plain.groups()
            same = known.get(word) if space else None
            first = len(flat)
            if same is not None and size[same]:  # met before, with other signs
                flat.extend(flat[at[same] : at[same] + size[same]])
            else:
                if not word.isascii():
                    word = word.translate(self.as_bytes)
                flat.extend([t.id for t in tokenize("Ġ" + word if space else word)])
            if signs:
                if signs not in ends:
                    ends[signs] = [t.id for t in tokenize(signs)]
                flat.extend(ends[signs])
            n = places[k]
            at[n], size[n] = first, len(flat) - first
        return rest

    def _encode_new(self, words: list[str], other: list[str]) -> pa.Array:
        """The ids of lower-cased words of letters, of which the model gets many at once, and of other texts."""
        ids = [np.zeros(0, np.uint32)]
        if words:
            rows = [codecs.charmap_decode(" ".join(words[i : i + WORDS]).encode(), "strict", _TABLE)[0] for i in range(0, len(words), WORDS)]
            ids += [np.array(e.ids, np.uint32) for e in self.words.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.concatenate(ids)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or len(ids) and ends[-1] != len(ids):
            raise ValueError("words do not part where their tokens end")
        more = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)] if other else []
        return _binaries(np.concatenate([ids, *more]), np.append(ends, len(ids) + np.cumsum([len(m) for m in more])))

    def _encode_words(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """encode(texts) where every space or line feed lies between words."""
        texts = pa.array([t or "" for t in texts], pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = lists.values.dictionary_encode()
        found = chunks.dictionary
        words, signs = pc.utf8_rtrim(found, _SIGNS), pc.utf8_ltrim(found, _LETTERS)
        in_word = pc.binary_length(words).to_numpy()
        plain = (in_word > 0) & (in_word + pc.binary_length(signs).to_numpy() == pc.binary_length(found).to_numpy())
        words = pc.utf8_lower(words.filter(pa.array(plain))).dictionary_encode()
        rest = pa.concat_arrays([signs.filter(pa.array(plain)), found.filter(pa.array(~plain))]).dictionary_encode()
        pieces, n = pa.concat_arrays([words.dictionary, rest.dictionary]), len(words.dictionary)

        def encode(fresh):
            return self._encode_new(_strings(pieces.take(pa.array(fresh[fresh < n]))), _strings(pieces.take(pa.array(fresh[fresh >= n]))))

        ids = pa.concat_arrays([self.bare.ids_of(pieces, encode), pa.array([b""], pa.large_binary())])
        # each chunk's pieces: a word and the signs after it, or the chunk itself and nothing
        one, two = np.empty((2, len(found)), np.int64)
        of_rest = rest.indices.to_numpy() + n
        one[plain], two[plain] = words.indices.to_numpy(), of_rest[: len(words)]
        one[~plain], two[~plain] = of_rest[len(words) :], len(pieces)
        both = pc.binary_join_element_wise(ids.take(pa.array(one)), ids.take(pa.array(two)), pa.scalar(b"", pa.large_binary()))
        upto, data = _parts(both.take(chunks.indices))
        return data.view(np.uint32)[: upto[-1] // 4], np.diff(upto[lists.offsets.to_numpy()] // 4)

    def _flush(self):
        apart = self._flush_plain()
        if self.token_bytes is not None:  # words with a space before them are as well encoded one behind the other
            row = [k for k in apart if self.waiting[k][:1] == " " and not self.waiting[k][-1].isspace()]
            if len(row) > 1 and self._flush_row(row):
                done = set(row)
                apart = [k for k in apart if k not in done]
        for k, e in zip(apart, self.tokenizer.encode_batch_fast([self.waiting[k] for k in apart], add_special_tokens=False)):
            n, ids = self.places[k], e.ids
            self.at[n], self.size[n] = len(self.flat), len(ids)
            self.flat.extend(ids)
        self.waiting, self.places = [], []

    def _flush_row(self, row: list[int]) -> bool:
        """Encodes these waiting chunks as one text; False, and nothing done, if its ids don't part where chunks do."""
        chunks = [self.waiting[k] for k in row]
        ids = self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids  # without offsets
        upto = np.cumsum(self.token_bytes[ids])
        ends = np.cumsum([len(c.encode("utf-8")) for c in chunks])
        to = np.searchsorted(upto, ends) + 1
        if to[-1] != len(ids) or (upto[to - 1] != ends).any():
            return False
        first = len(self.flat)
        self.flat.extend(ids)
        for k, at, size in zip(row, (first + np.r_[0, to[:-1]]).tolist(), np.diff(to, prepend=0).tolist()):
            n = self.places[k]
            self.at[n], self.size[n] = at, size
        return True

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        if self.words_only:
            if np.count_nonzero(self.bare.met) > self.most:
                self.bare.turn()
            return self._encode_words(texts)
        if len(self.at) > self.most:
            self._turn()
        chunks, ends = [], []
        bare, spaced = self.bare, self.spaced
        for t in texts:
            t = t or ""
            if self.run.search(t):
                chunks.append(self.number(t))  # not remembered
            else:
                feed = False
                for line in t.split("\n"):
                    if feed:
                        chunks.append(bare["\n"])
                    feed = True
                    parts = line.split(" ")
                    chunks.append(bare[parts[0]])
                    if len(parts) > 1:
                        chunks.extend(map(spaced.__getitem__, parts[1:]))
            ends.append(len(chunks))
        self._flush()
        if not ends:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        n = np.array(chunks, dtype=np.int64)
        size = np.frombuffer(self.size, np.int32)[n].astype(np.int64)
        first = np.frombuffer(self.at, np.int64)[n]
        upto = np.cumsum(size)
        where = np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        ids = np.frombuffer(self.flat, np.uint32)[where] if len(where) else np.zeros(0, np.uint32)
        total = np.concatenate([[0], upto])[np.concatenate([[0], np.array(ends)])]
        return ids, np.diff(total)


def encoder(name_or_path: str) -> BatchEncoder:
    """This worker's encoder of that name; its memo is kept from batch to batch and task to task."""
    return kept(("encoder", name_or_path), lambda: BatchEncoder(name_or_path))


def in_steps(pdf, most_chars: int = 4_000_000, text: str = "text"):
    """Slices of a frame of at most about that many characters, one row at least."""
    sizes = pdf[text].fillna("").str.len().to_numpy().cumsum() if len(pdf) else np.zeros(0)
    at = 0
    while at < len(pdf):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most_chars, "right")))
        yield pdf.iloc[at:to]
        at = to
