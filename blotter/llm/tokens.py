"""Token ids of whole texts, word by word.

The public tokenizers used here never join characters across white space: the normaliser
works inside words (NFC, lower case) and the pre-tokenizer splits at white space.  A text's
ids are therefore the ids of its words one after the other, and a word met before costs a
dictionary look-up instead of a BPE run.  (ASCII letters are lowered first, which the
normaliser does anyway.)  ``test_tokens.py`` holds this against the library's
encoding of the whole text.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from blotter.llm.common import encoded

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHED_WORDS = 500_000  # per Python worker, in two generations; the older one goes when the newer is full
LOOKED_UP = 1 << 15  # words looked up at once


def public_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Between the words of one call to the library.  A digit is always a token of its own, and no
#: other character has its id; words that hold it are encoded one by one.
SEPARATOR = b"0"
CALL_WORDS = 500
CALL_BYTES = 8_000_000  # texts whose words are told apart at once

#: Letters that the normaliser leaves alone; a word of them is one piece for the pre-tokenizer, and other ASCII
#: signs after it (but the apostrophe) are the next one.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != ord("'"))
#: The file's rules that this holds for; with others every word goes through the whole tokenizer.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _known_rules(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return ((rules.get("normalizer") or {}).get("normalizers") == NORMALIZER and len(steps) == 2
            and (steps[0].get("pattern"), steps[0].get("behavior"), steps[0].get("invert")) == ({"Regex": SPLIT}, "Removed", True)
            and (steps[1]["type"], steps[1]["add_prefix_space"], steps[1]["use_regex"]) == ("ByteLevel", False, False)
            and rules.get("post_processor") is None
            and all(t["content"][:2] == "<|" for t in rules["added_tokens"]))


class Encoder:
    """Words to ids (little-endian unsigned 32-bit bytes), with a cache of bounded size."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.separator = np.frombuffer(self._alone(SEPARATOR), "<u4")
        self.signs: dict[bytes, bytes] = {}
        self.plain = None  # the same model without the rules that change nothing in plain words
        if _known_rules(path):
            from tokenizers import pre_tokenizers
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = None
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _alone(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, new: set[bytes]) -> None:
        plain = set(filter(PLAIN, new)) if self.plain else set()
        rest = new.difference(plain)
        odd = {w for w in rest if SEPARATOR in w or b"<|" in w} if len(self.separator) == 1 else new
        for words, tokenizer in ((plain - odd, self.plain), (rest - odd, self.tokenizer)):
            self._learn_joined(list(words), tokenizer)
        for word in odd:
            self.cache[word] = self._alone(word)

    def _learn_joined(self, words: list[bytes], tokenizer) -> None:
        cache, between = self.cache, b" " + SEPARATOR + b" "
        for i in range(0, len(words), CALL_WORDS):
            part = words[i:i + CALL_WORDS]
            text = between.join(part).decode("utf-8", "replace")
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator[0])
            blob, at = ids.tobytes(), 0
            for word, cut in zip(part, [*(4 * cuts).tolist(), len(blob)]):
                cache[word] = blob[at:cut]
                at = cut + 4

    def encode(self, texts: list[str | None], end_id: int | None = END_ID) -> list[bytes]:
        """Ids of each text (null: none), ``end_id`` appended, as little-endian uint32 bytes."""
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        out, group, size = [], [], 0
        for text in texts:
            group.append(encoded(text))
            size += len(group[-1])
            if size >= CALL_BYTES:
                out += self._encode_texts(group, end)
                group, size = [], 0
        return out + self._encode_texts(group, end)

    def _encode_texts(self, group: list[bytes], end: bytes) -> list[bytes]:
        """Each different word of the texts is looked up once."""
        texts = pa.array(group, pa.large_binary()).view(pa.large_string())
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # a leading or last empty word has no ids
        at = words.offsets.to_numpy().tolist()
        coded = words.values.view(pa.large_binary()).dictionary_encode()
        ids, number = self._word_ids(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        return [b"".join(map(ids.__getitem__, number[a:b].tolist())) + end for a, b in zip(at, at[1:])]

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words, a bounded number of them at once."""
        out, step = [], min(LOOKED_UP, max(1, CACHED_WORDS // 4))
        for i in range(0, len(words), step):
            some = words[i:i + step]
            stems, last = some, []
            if self.plain:  # a plain word and the signs after it are separate tokens
                stems = [stem if (stem := w.rstrip(SIGNS)) != w and PLAIN(stem) else w for w in some]
                last = [(k, w[len(stem):]) for k, (w, stem) in enumerate(zip(some, stems)) if len(w) > len(stem)]
            used = set(stems)
            new = used.difference(self.cache)
            if len(new) + len(self.cache) > CACHED_WORDS // 2:
                self.older, self.cache = self.cache, {}
                new = used
            kept = new.intersection(self.older)
            self.cache.update(zip(kept, map(self.older.__getitem__, kept)))
            if new := new.difference(kept):
                self._learn(new)
            ids = list(map(self.cache.__getitem__, stems))
            for k, signs in last:
                if signs not in self.signs:
                    if len(self.signs) >= CACHED_WORDS // 50:
                        self.signs.clear()
                    self.signs[signs] = self._alone(signs)
                ids[k] += self.signs[signs]
            out += ids
        return out

    def forget(self) -> None:
        """Drop the words met so far; the tokenizers stay."""
        self.cache, self.older, self.signs = {}, {}, {}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder.  Workers are reused between tasks, so are its tokenizers; a task
    that is done forgets its words, as an idle worker's memory is the executor's too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
