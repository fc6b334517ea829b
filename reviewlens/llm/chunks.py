"""Token ids of long texts by way of a table of their distinct chunks.

Where no token can reach across a certain place of a text, the pieces on either side are encoded independently.
A text is then the sequence of its chunks: each distinct chunk is encoded once, and the ids are joined back by
position. A table belongs to a worker process and is emptied when it holds `max_entries` chunks, so its memory is
bounded and no result depends on it. Ids are kept as little-endian 32-bit numbers in bytes.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable
from functools import cache, lru_cache

import numpy as np


class ChunkTable:
    def __init__(self, encode: Callable[[list[str]], list[bytes]], max_entries: int = 150_000, max_key: int = 64):
        self.encode, self.max_entries, self.max_key = encode, max_entries, max_key
        self.ids: dict[str, bytes] = {"": encode([""])[0]}
        self.before: dict[str, bytes] = {}

    def join(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its chunks.

        A full table steps back to be the one before, from which chunks still in use are taken over. Chunks above
        `max_key` letters are not kept.
        """
        wanted = set().union(*texts)
        missing = wanted.difference(self.ids)
        if len(self.ids) + len(missing) > self.max_entries:
            self.before, self.ids = self.ids, {"": self.ids[""]}
            missing = wanted.difference(self.ids)
        self.ids.update({c: self.before[c] for c in missing.intersection(self.before)})
        todo = list(missing.difference(self.before))
        self.ids.update(zip(todo, self.encode(todo)))
        get = self.ids.__getitem__
        joined = [b"".join(map(get, chunks)) for chunks in texts]
        for chunk in todo:
            if len(chunk) > self.max_key:
                del self.ids[chunk]
        return joined


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


#: A full stop or comma after anything but these letters, digits and gaps may belong to a run of signs.
_SIGN_RUN = re.compile(r"[^a-zA-Z0-9 \nÀ-ÖØ-öø-ÿ][.,]")
#: A word of letters that lower-case and compose one by one, and signs behind it that are a token run of their own.
_WORD = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_AT_ONCE = 2000


def word_chunks(text: str) -> list[str]:
    """Chunks of a text for a word model that ignores case and white space: cut at spaces, line ends, before commas.

    Case goes first where every letter has one simple lower case of its own. It stays where a control string may stand:
    these are looked up in the text as it is, so one in other letters is none.
    """
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    if not _SIGN_RUN.search(text):
        text = text.replace(",", " ,").replace(".", " .")
    return text.replace("\n", " ").split(" ")


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(hidden)}


@cache
def word_table(path: str) -> ChunkTable:
    """Table for a `tokenizers` file whose pre-tokenizer drops white space and keeps letters apart from signs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    specials = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    stop, stop_id = max(specials.items(), key=lambda item: item[1])

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    model, letters = tokenizer.model, byte_letters()

    def word_ids(word: str) -> list[int]:
        """A plain word needs neither normalising nor cutting, so it goes straight to the merges."""
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(letters)
        return [t.id for t in model.tokenize(word)]

    @lru_cache(100_000)
    def signs(run: str) -> bytes:
        return packed(ids_of([run])[0])

    trial = ["Hello", "été", "Straße", "ÀÖØÞ", "naïve", "ooooooooo", "I"]
    direct = [word_ids(w) for w in trial] == ids_of(trial)

    def encode(chunks: list[str]) -> list[bytes]:
        """Many chunks go to the library as one text with a special token between them, which then parts the ids."""
        out = {}
        for chunk in chunks if direct else ():
            if chunk.isalpha() and (chunk.isascii() or max(chunk) <= "ÿ"):
                out[chunk] = packed(word_ids(chunk))
            elif (match := _WORD.fullmatch(chunk)) and stop[:2] not in match[2]:
                out[chunk] = packed(word_ids(match[1])) + signs(match[2])
        odd = [c for c in chunks if stop[:2] in c]
        out.update((c, packed(i)) for c, i in zip(odd, ids_of(odd)))
        plain = [c for c in chunks if c not in out]
        groups = [plain[i : i + _AT_ONCE] for i in range(0, len(plain), _AT_ONCE)]
        for group, ids in zip(groups, ids_of([stop.join(g) for g in groups])):
            flat = np.asarray([*ids, stop_id], dtype="<i4")
            ends = np.flatnonzero(flat == stop_id)
            data, starts = flat.tobytes(), np.concatenate([[0], ends[:-1] + 1])
            out.update(zip(group, (data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist()))))
        return [out[c] for c in chunks]

    return ChunkTable(encode)


MARK = "▁"
_MARKED = re.compile(r" +[^ \n]*|\n[^ \n]*")


def piece_chunks(text: str) -> list[str]:
    """Chunks of a text for a piece model whose pieces hold the space mark only in front, and no line end.

    The marked text is cut before every run of spaces and before every line end. A chunk that begins with a space
    is named without that space, as the library itself puts one in front; a lone space is named by the empty
    string; a chunk that begins with a line end keeps it.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    spaced = text.replace("\n", " \n")
    if "  " in spaced or spaced[0] == " " or spaced[-1] == " ":
        return [c[1:] if c[0] == " " else c for c in _MARKED.findall(" " + text)]
    return spaced.split(" ")


@cache
def piece_table(path: str) -> tuple[ChunkTable, Callable[[str], list[str]]]:
    """Table and cutter for a sentencepiece model; the whole text is one chunk if the model's pieces forbid cuts."""
    model = piece_model(path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    reaching = [p for p in pieces if "\n" in p or " " in p or re.search(f"[^{MARK}]{MARK}", p)]
    mark = model.piece_to_id(MARK)
    # Cutting supposes that spaces are marked as they are: one in front, none dropped, nothing else rewritten.
    plain = [model.decode(model.encode(t)) == t for t in (" a  b ", "éΩﬁ", "é \t\r")]
    if reaching or not all(plain) or pieces[model.encode("a")[0]][0] != MARK:
        return ChunkTable(lambda chunks: [packed(i) for i in model.encode(chunks, num_threads=1)], 1), lambda t: [t]

    def encode(chunks: list[str]) -> list[bytes]:
        return [
            packed(ids[1:] if chunk[:1] == "\n" else ids) if chunk else packed([mark])
            for chunk, ids in zip(chunks, model.encode(chunks, num_threads=1))
        ]

    return ChunkTable(encode), piece_chunks


@cache
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each id stands for: all bytes in one array, the start of each id's, their number."""
    model = piece_model(path)
    surfaces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            surfaces.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i):
            surfaces.append(b"")
        elif model.is_unknown(i):
            surfaces.append(model.decode([i]).encode())
        else:
            surfaces.append(piece.replace(MARK, " ").encode())
    lengths = np.array([len(s) for s in surfaces], dtype=np.int64)
    return np.frombuffer(b"".join(surfaces), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


def decode_pieces(path: str, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of ids laid end to end, one text between each two `bounds`; the model's leading space is dropped."""
    data, starts, lengths = piece_bytes(path)
    taken = lengths[ids]
    ends = np.concatenate([[0], np.cumsum(taken)])
    where = np.repeat(starts[ids] - ends[:-1], taken) + np.arange(ends[-1])
    out = data[where].tobytes()
    cuts = ends[bounds]
    texts = [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    return [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]
