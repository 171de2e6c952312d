"""Byte-level BPE as a token automaton.

The automaton reads tokens; its paths are exactly the tokenizations that the merges produce, so every byte string labels one
path. It starts with one state that loops on all byte tokens. Each merge (u, v), in order, is a gadget: the state that u leads
to is copied without its arc v, u now leads to the copy, and wherever u may be read the new token uv may be read too, leading to
where v led. All arcs with one label lead to one state, so a state is a token's last gadget copy, and a table row needs
only the arcs that its gadgets took away; the others are looked up in the state it was copied from (``may_follow``).

Encoding looks for the one path of a word: from each place reached, the longest token that fits is tried first, then shorter ones. As a
prefix has one path only, a place from which no token leads on is never tried again, so each place is left once at most; nothing is
remembered for a word but its places. Decoding emits the arcs' byte labels.

Defined cases: a null or empty text has no tokens; repeated rows are encoded row by row; empty tables give no rows; a text of any
length is split into words first and never held as tokens of several texts at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm.memory import returned

CACHE = 250_000  # distinct words that a task remembers; only their encoding is saved, nothing is dropped
ARCS = 100_000  # pairs of tokens that a task remembers; a full table is begun anew
ROWS = 64  # texts that a task holds as Python strings
# The pre-split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts in which every letter is one of LETTERS and every digit is 0-9; the standard module is much faster.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
PLAIN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^{LETTERS}0-9 \\t-\\r\u0085 ]+|"
         "[ \\t-\\r\u0085 ]+(?![^ \\t-\\r\u0085 ])|[ \\t-\\r\u0085 ]+")
NOT_PLAIN = f"[^\\x00-\\x7f{LETTERS}\u0080-©«-±´¶-¸»¿×÷]"


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Compiled merges: token labels, arcs taken away by gadgets, and the trie of all labels."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], specials: dict[str, int]):
        self.labels, self.specials = labels, specials
        self.token_of = {label: t for t, label in labels.items() if t not in specials.values()}
        size = max(labels, default=0) + 1
        self.born, self.left, self.right = (array("i", [x]) * size for x in (-1, 0, 0))
        self.gone: dict[int, int] = {}  # (token, arc taken from the state behind it) -> number of the gadget
        for step, (u, v, new) in enumerate(merges):
            self.gone.setdefault(u * size + v, step)
            if self.born[new] < 0:
                self.born[new], self.left[new], self.right[new] = step, u, v
        self.size = size
        self.arcs: dict[int, bool] = {}
        self.lengths = array("i", [len(labels.get(t, b"")) for t in range(size)])
        self.longest = max(self.lengths)
        # The trie of all labels: node and byte to node, and the token that a node is (or -1).
        self.child: dict[int, int] = {}
        self.ends = array("i", [-1])
        for label, token in self.token_of.items():
            node = 0
            for byte in label:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                node = self.child[key]
            self.ends[node] = token

    def __getstate__(self) -> dict:
        """What tasks need; the trie has the tokens of labels."""
        return {k: v for k, v in self.__dict__.items() if k != "token_of"}

    def may_follow(self, token: int, arc: int) -> bool:
        """Whether the state behind ``token`` has the arc, once all gadgets are in place."""
        key = token * self.size + arc
        known = self.arcs.get(key)
        if known is None:
            now, a, b = 1 << 60, token, arc
            known = True
            while True:
                gadget = self.gone.get(a * self.size + b)
                if gadget is not None and gadget < now:
                    known = False  # some gadget took this arc before the younger of both tokens was made
                    break
                if self.born[a] < 0 and self.born[b] < 0:
                    break
                if self.born[a] > self.born[b]:  # the state behind a was copied from that behind its right part
                    now, a = self.born[a], self.right[a]
                else:  # the arc b was added wherever its left part could be read once the gadget was in place
                    now, b = self.born[b] + 1, self.left[b]
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def encode(self, word: bytes) -> list[int]:
        child, ends, lengths, arcs, size = self.child, self.ends, self.lengths, self.arcs, self.size
        path, untried, dead, at, before = [], [], set(), 0, -1
        while at < len(word):
            node, found = 0, []  # the tokens that begin here, by length
            for byte in word[at:at + self.longest]:
                node = child.get(node << 8 | byte, -1)
                if node < 0:
                    break
                if ends[node] >= 0:
                    found.append(ends[node])
            while True:
                if not found:  # no token leads on from here: back to the place before
                    dead.add(at)
                    if not path:
                        raise KeyError(word)
                    at -= lengths[path.pop()]
                    found, before = untried.pop(), path[-1] if path else -1
                    continue
                token = found.pop()
                if at + lengths[token] in dead:
                    continue
                if before < 0:
                    break
                fits = arcs.get(before * size + token)
                if self.may_follow(before, token) if fits is None else fits:
                    break
            path.append(token)
            untried.append(found)
            at += lengths[token]
            before = token
        return path

    def decode(self, ids) -> bytes:
        labels = self.labels
        return b"".join([labels[i] for i in ids])


def compile_merges(path: str) -> Automaton:
    """The automaton of a byte-level BPE file in the JSON format of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, letters = file["model"], byte_letters()
    specials = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
    labels = {i: t.encode() if t in specials else bytes(letters[c] for c in t) for t, i in model["vocab"].items()}
    labels |= {i: t.encode() for t, i in specials.items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    return Automaton(labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], specials)


class Splitter:
    """Cuts a text at special tokens and then into words."""

    def __init__(self, specials: dict[str, int]):
        import regex

        self.full, self.plain, self.odd = regex.compile(PATTERN), re.compile(PLAIN), re.compile(NOT_PLAIN)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.specials = specials

    def words(self, text: str) -> list[str]:
        pattern = self.full if re.search("[\x1c-\x1f]", text) or self.odd.search(text) else self.plain
        return pattern.findall(text)

    def parts(self, text: str) -> list[tuple[str, bool]]:
        if self.special is None or not any(s in text for s in self.specials):
            return [(text, False)]
        return [(p, p in self.specials) for p in self.special.split(text) if p]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Some rows of a batch at a time; the batch itself if it is empty."""
    for at in range(0, max(1, batch.num_rows), ROWS):
        yield batch.slice(at, ROWS)


def _encoder(model, full: bool, remembered: int = CACHE):
    def run(batches):
        automaton = model.value
        split, joined, odd = Splitter(automaton.specials), {}, {}  # a word's ids; its bytes if decoding gives others
        for batch in (part for whole in batches for part in _slices(whole)):
            out = []
            for text in batch.column("text").to_pylist():
                digest, decoded = [], []
                for part, special in split.parts(text or ""):
                    if special:
                        digest.append(str(automaton.specials[part]))
                        decoded.append(automaton.decode([automaton.specials[part]]))
                        continue
                    words = split.words(part)
                    if len(joined) > remembered:
                        joined.clear()
                        odd.clear()
                    for w in set(words).difference(joined):
                        raw = w.encode("utf-8", "surrogatepass")
                        own = automaton.encode(raw)
                        joined[w] = ",".join(map(str, own))
                        back = automaton.decode(own)
                        if back != raw:
                            odd[w] = back
                    digest += [joined[w] for w in words]
                    if not odd or odd.keys().isdisjoint(words):
                        decoded.append("".join(words).encode("utf-8", "surrogatepass"))
                    else:
                        decoded += [odd[w] if w in odd else w.encode("utf-8", "surrogatepass") for w in words]
                back = b"".join(decoded).decode("utf-8", "replace")
                all_ids = ",".join(digest)
                out.append((all_ids.count(",") + 1 if all_ids else 0, hashlib.sha256(all_ids.encode()).hexdigest(),
                            hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
                            *([[int(x) for x in all_ids.split(",") if x]] if full else [])))
            cols = list(zip(*out)) or [[]] * (4 if full else 3)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            arrays = [batch.column("kept"), *[pa.array(c, t) for c, t in zip(cols, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["kept", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(arrays)])
    return run


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     ids: bool = True, remembered: int = CACHE) -> DataFrame:
    """The kept columns, n_tokens, ids_sha256, decoded_sha256 and, if wanted, the ids themselves.

    The compiled automaton is broadcast: its size is that of the vocabulary file. ``remembered`` is the number of words that a task keeps
    the ids of; fewer take less memory and more time.
    """
    model = docs.sparkSession.sparkContext.broadcast(compile_merges(vocabulary))
    plain = docs.select(F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept"),
                        F.col(text).cast("string").alias("text"))
    fields = plain.schema["kept"].dataType.simpleString()
    out = plain.mapInArrow(returned(_encoder(model, ids, remembered)), f"kept {fields}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                           + (", ids array<int>" if ids else ""))
    return out.select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], *out.columns[1:])


def decode_documents(encoded: DataFrame, vocabulary: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``text``: the arcs' labels, with bytes that are not UTF-8 replaced; null ids give a null text."""
    model = encoded.sparkSession.sparkContext.broadcast(compile_merges(vocabulary))

    def run(batches):
        for batch in batches:
            texts = [None if x is None else model.value.decode(x).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], ["kept", "text"])

    plain = encoded.select(F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept"), F.col(ids).alias("ids"))
    out = plain.mapInArrow(run, f"kept {plain.schema['kept'].dataType.simpleString()}, text string")
    return out.select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "text")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary(), ids=False)
