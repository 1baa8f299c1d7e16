"""A SentencePiece model's pieces, read through the ``sentencepiece`` library.

Texts are prepared as the supported models ask: identity normaliser, one space
put in front, spaces written as U+2581.  A prepared text is cut into chunks that
no piece crosses: runs of spaces with the word that follows them, and line
feeds; a word of letters also ends before a mark of ``MARKS`` that no piece has
after a letter.  (If some piece has a space after another character, or holds a
line feed, the whole text is one chunk.)
"""

from __future__ import annotations

import re

import numpy as np

SPACE = "▁"
MARKS = ",.;:!?"


class PieceModel:
    """Pieces, scores and the kind of a model, from the bytes of its file."""

    def __init__(self, data: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(data)
        norm = proto.normalizer_spec
        if norm.name != "identity" or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models with the identity normaliser and a space in front are supported")
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.size = sp.vocab_size()
        self.kind = {1: "unigram", 2: "bpe"}[proto.trainer_spec.model_type]
        self.piece = [sp.id_to_piece(i) for i in range(self.size)]
        self.score = np.array([sp.get_score(i) for i in range(self.size)])
        ordinary = [i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id_of = {self.piece[i]: i for i in ordinary}
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        if len(self.byte_id) != 256:
            raise ValueError("only models with all byte pieces are supported")
        self.control = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i)}
        # text of a piece by itself; None for the bytes of characters beyond ASCII
        self.plain = ["" if i in self.control else self.piece[i].replace(SPACE, " ") for i in range(self.size)]
        for i, b in self.byte_of.items():
            self.plain[i] = chr(b) if b < 128 else None
        self.unknown_score = float(min(self.score[i] for i in ordinary)) - 10.0
        self.longest = max(map(len, self.id_of))
        whole = any(SPACE in p.lstrip(SPACE) or (SPACE in p and "\n" in p) for p in self.id_of) or any("\n" in p and p != "\n" for p in self.id_of)
        after_letter = {b for p in self.id_of for a, b in zip(p, p[1:]) if a.isalpha()}
        marks = re.escape("".join(c for c in MARKS if c not in after_letter))
        ends = f"{SPACE}*[^\\W\\d_]++(?=[{marks}])|" if marks else ""
        self._chunks = re.compile("(?s).+" if whole else f"{ends}{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def chunks(self, text: str) -> list[str]:
        """The prepared text, in chunks that no piece crosses."""
        return self._chunks.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def bytes_of(self, char: str) -> list[int]:
        """Byte pieces of a character that is no piece."""
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]

    def decode(self, ids) -> str:
        """Text of a list of ids: bytes are joined and read as UTF-8 (wrong ones
        become U+FFFD), control pieces are left out, the space in front is dropped."""
        plain = list(map(self.plain.__getitem__, ids))
        if None in plain:
            out, held = [], bytearray()
            for i, p in zip(ids, plain):
                if p is None:
                    held.append(self.byte_of[i])
                else:
                    if held:
                        out.append(held.decode("utf-8", "replace"))
                        held = bytearray()
                    out.append(p)
            if held:
                out.append(held.decode("utf-8", "replace"))
            plain = out
        text = "".join(plain)
        return text[1:] if text.startswith(" ") else text
