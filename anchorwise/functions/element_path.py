"""A path of element names inside a document, and tests on it."""

from __future__ import annotations

from functools import lru_cache


class ElementPath:
    """`at` holds if the path ends with the given one (equals it, if that begins with a slash); `within` if the given one
    occurs in it (begins it, with a slash). "/" is the empty path. Empty names in a given path are errors."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def push(self, name: str) -> None:
        self.names.append(name)

    def pop(self) -> str:
        if not self.names:
            raise IndexError("the path is empty")
        return self.names.pop()

    @staticmethod
    @lru_cache(maxsize=1024)
    def _parse(path: str) -> tuple[bool, list[str]]:
        absolute = path.startswith("/")
        names = path[absolute:].rstrip("/").split("/")
        if "" in names:
            raise ValueError(f"empty element in {path!r}")
        return absolute, names

    def at(self, path: str) -> bool:
        if path == "/":
            return not self.names
        absolute, names = self._parse(path)
        return self.names == names if absolute else self.names[-len(names) :] == names

    def within(self, path: str) -> bool:
        if path == "/":
            return True
        absolute, names = self._parse(path)
        if not absolute and len(names) == 1:
            return names[0] in self.names
        places = [0] if absolute else range(len(self.names) - len(names) + 1)
        return any(self.names[p : p + len(names)] == names for p in places)
