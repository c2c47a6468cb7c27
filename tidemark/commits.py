"""A log of numbered commits: the state of a stored table, replaced as a whole.

A commit is one new numbered file, created whole or not at all. A writer that finds its number
taken reads the newer state and applies its change to that. Files that a failed writer left
unfinished are passed over; the finished one before them stays in force.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemark import files
from tidemark.errors import CommitConflict

# How often a writer that finds its commit number taken tries the next one.
_ATTEMPTS = 50


class CommitLog:
    """The commits in one folder. A state is a dict of plain values."""

    def __init__(self, spark: SparkSession, folder: str, owner: str) -> None:
        self.spark = spark
        self.folder = folder
        self.owner = owner

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def last_number(self) -> int:
        """Number of the last commit: from the pointer and what follows it, else by listing."""
        try:
            number = int(files.read_text(self.spark, f"{self.folder}/latest"))
            known = files.exists(self.spark, self._name(number))
        except Exception:  # no pointer, or one that is being written: it is a shortcut only
            known = False
        if not known:
            names = files.names_in(self.spark, self.folder)
            number = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)
        while number and files.exists(self.spark, self._name(number + 1)):
            number += 1
        return number

    def read(self) -> tuple[int, int, dict | None]:
        """The last number that is taken, the number of the last finished commit (0 for none),
        and its state."""
        last = number = self.last_number()
        while number:
            try:
                return last, number, json.loads(files.read_text(self.spark, self._name(number)))
            except json.JSONDecodeError:
                number -= 1
        return last, 0, None

    def commit(self, change: Callable[[dict | None], dict | None]) -> bool:
        """Apply `change` to the current state; again on the newer one if another writer was
        first. False if `change` finds nothing to do (it returns None)."""
        for _ in range(_ATTEMPTS):
            last, _, state = self.read()
            new = change(state)
            if new is None:
                return False
            if files.create_text(self.spark, self._name(last + 1), json.dumps(new)):
                files.write_text(self.spark, f"{self.folder}/latest", str(last + 1))
                return True
        raise CommitConflict(f"{self.owner}: other writers were first {_ATTEMPTS} times")

    def forget_before(self, number: int, old: Callable[[str], bool]) -> None:
        """Remove commits below `number` for whose path `old` holds."""
        for name in files.names_in(self.spark, self.folder):
            own = name.removesuffix(".json")
            if own.isdecimal() and int(own) < number and old(f"{self.folder}/{name}"):
                files.remove(self.spark, f"{self.folder}/{name}")
