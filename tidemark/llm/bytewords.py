"""Words of whole UTF-8 texts by a byte table and ``bytes.split``, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

PIECE = 1 << 20


def table(blank: bytes | range | list[int]) -> bytes:
    """A 256-byte table that puts A-Z in lower case and turns the bytes ``blank`` into spaces.

    No byte of a multi-byte UTF-8 character is below 128, so such characters pass whole.
    """
    out = bytearray(range(256))
    out[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    for b in blank:
        out[b] = 0x20
    return bytes(out)


def pieces(text: bytes, by: bytes, overlap: int = 0, size: int = PIECE) -> Iterator[tuple[list[bytes], int]]:
    """(words, how many of them the piece before had too) for consecutive pieces of a text.

    A piece ends at the first blank after ``size`` bytes; it begins with the last ``overlap`` words so far,
    so every run of ``overlap`` + 1 words lies whole in exactly one piece in which its last word is new.
    """
    at, last = 0, []
    while at < len(text):
        part = text[at : at + size].translate(by)
        at += len(part)
        if at < len(text):
            stop = part.rfind(b" ")
            if stop >= 0:
                at -= len(part) - stop - 1
                part = part[: stop + 1]
            else:  # a word longer than a piece: on to its end
                more = [part]
                while at < len(text):
                    part = text[at : at + size].translate(by)
                    stop = part.find(b" ")
                    more.append(part if stop < 0 else part[: stop + 1])
                    at += len(more[-1])
                    if stop >= 0:
                        break
                part = b"".join(more)
        new = part.split()
        if new:
            yield last + new, len(last)
            last = (last + new)[-overlap:] if overlap else []
