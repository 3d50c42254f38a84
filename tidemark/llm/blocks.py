"""Encoding texts by their distinct words, a bounded block of whole texts at a time."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]  # words -> ids, n + 1 offsets


class WordNumbers(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def encoded_blocks(
    texts: Iterable[str], split: Callable[[str], list[str]], encode: Encode, block_words: int, block_pieces: int
) -> Iterator[np.ndarray]:
    """The ids of each text, in turn: those of its words, one after another. `encode` sees every
    word of a block once. A block ends at so many distinct words, or words in all."""
    numbers, docs, held = WordNumbers(), [], 0

    def flush() -> Iterator[np.ndarray]:
        ids, ends = encode(list(numbers))
        sizes = np.diff(ends)
        for doc in docs:
            n = sizes[doc]
            stops = np.cumsum(n)
            total = int(stops[-1]) if len(doc) else 0
            yield ids[np.arange(total) - np.repeat(stops - n, n) + np.repeat(ends[doc], n)]

    for text in texts:
        found = split(text)
        docs.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        held += len(found)
        if len(numbers) >= block_words or held >= block_pieces:
            yield from flush()
            numbers, docs, held = WordNumbers(), [], 0
    yield from flush()
