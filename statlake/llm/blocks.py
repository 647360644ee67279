"""Cuts batches of texts into blocks of bounded size, so that a task's memory does not follow its input."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK = 1 << 20
FIRST_SPACE = re.compile("(?<! ) ")


def text_blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """Lists of (row, text) of about ``size`` characters; longer texts are cut in front of a run of spaces.

    The parts of a text come in order, join to the whole text, and each but the first begins with a
    space and follows one that ends without. A text without spaces stays one part. NULL and empty texts come as one empty part.
    """
    block, held = [], 0
    for row, text in enumerate(texts):
        text = text or ""
        start = 0
        while True:
            cut = FIRST_SPACE.search(text, start + size) if len(text) - start > size else None
            end = cut.start() if cut else len(text)
            block.append((row, text[start:end]))
            held += end - start
            if held >= size:
                yield block
                block, held = [], 0
            start = end
            if start == len(text):
                break
    if block:
        yield block


class Cache(dict):
    """A dict that is emptied when it is full."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room(self, more: int) -> None:
        if len(self) + more > self.limit:
            self.clear()
