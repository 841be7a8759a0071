"""What the tests of this folder share besides fixtures."""

import random
import zlib


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(words))


def rows(texts_by_id, source="s"):
    """Rows of `documents`: id and text, then lang, source, n_chars and eight clashing columns."""
    return [(i, text, "en", source, 0, *([7] * 8)) for i, text in texts_by_id]
