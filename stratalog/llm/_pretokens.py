"""Cutting texts where no token of a vocabulary crosses, so that each piece is encoded once and looked up after."""

from __future__ import annotations

import os
import re
from array import array

from stratalog.functions.shared import released

#: Entries of a worker's cache, and the longest piece that is kept.
CACHE_ENTRIES, CACHE_CHARS = 250_000, 64

_SPACED = re.compile(r" ( *[^ ]*)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_EDGE = re.compile(r"(?<=\S)(?= \S)")


def sentence_pieces(text: str) -> list[str]:
    """Pieces of a text of which each, encoded alone, has the tokens that it has within the text.

    A vocabulary with word-begin marks has no token with a mark behind another character, so a cut before a run of
    spaces is safe; the encoder puts one mark before any text, which stands for the first space of the run. A literal
    mark in the text is a space to the encoder, and such a text stays whole, as does one that ends in a space: a lone
    mark at its end has no piece to stand in for it.
    """
    if not text:
        return []
    if "▁" in text or text[-1] == " ":
        return [text]
    if "  " in text or text[0] == " ":
        return _SPACED.findall(" " + text)
    return text.split(" ")


def byte_pieces(text: str) -> list[str]:
    """Pieces that start at the single spaces between two other characters, each with its space.

    The byte-level pattern lets a space stand only before the word, number or sign run that follows it, so a match
    never crosses such a space.
    """
    if not text:
        return []
    if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _OTHER_SPACE.search(text):
        return _EDGE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class Lengths(dict):
    """Piece to number of tokens. What the dict itself holds is the broadcast tier; misses go through a bounded cache."""

    def __init__(self, encode, hot=()):
        super().__init__(hot)
        self.encode, self.cold = encode, {}

    def __missing__(self, piece: str) -> int:
        n = self.cold.get(piece)
        if n is None:
            n = len(self.encode(piece))
            if len(piece) <= CACHE_CHARS:
                if len(self.cold) >= CACHE_ENTRIES:
                    self.cold.clear()
                self.cold[piece] = n
        return n


def encoder(path: str):
    """text -> list of ids, by the library for the file's kind, one thread."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: model.encode(text, num_threads=1)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def id_bytes(path: str, ranks: str | None = None, pattern: str | None = None):
    """text -> its ids as little-endian 32-bit bytes.

    ranks: a file with the vocabulary of path as ranks, and pattern the expression that cuts texts. Both libraries then
    give the same ids for ordinary text, this one several times faster; texts with a special string go to the first.
    """
    encode = encoder(path)
    if ranks is None:
        return lambda text: array("I", encode(text)).tobytes()
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
    from tokenizers import Tokenizer

    special = tuple(x.content for x in Tokenizer.from_file(path).get_added_tokens_decoder().values())
    return lambda text: array("I", encode(text) if any(x in text for x in special) else plain(text)).tobytes()


#: One encoder and its cache for each file, as long as a worker lives.
_KEPT: dict = {}


def kept(key, make):
    if key not in _KEPT:
        _KEPT[key] = make()
        released()  # what reading its file took
    return _KEPT[key]


def readable(body: bytes | None) -> str:
    return body.decode("utf-8", "replace") if body else ""
