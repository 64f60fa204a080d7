"""Locks with an age: which pages a worker holds, in a SQLite file that the workers of one machine share.

Spark's tasks need none of it; it serves tools that write beside a job. ``acquire`` takes a lock that is free or older than the
age; of two workers the database lets one win.
"""

from __future__ import annotations

import sqlite3
import time

MAX_AGE = 600.0
WAIT = 60.0


class Locks:
    def __init__(self, path: str, age: float = MAX_AGE):
        self.age = age
        self.db = sqlite3.connect(path, timeout=WAIT, isolation_level=None)
        self.db.execute("CREATE TABLE IF NOT EXISTS held (name TEXT PRIMARY KEY, owner TEXT, since REAL)")

    def acquire(self, name: str, owner: str, now: float | None = None) -> bool:
        """Whether ``owner`` has the lock now; one that is too old is taken away first. Taking it again renews it."""
        now = time.time() if now is None else now
        self.db.execute("BEGIN IMMEDIATE")
        try:
            self.db.execute("DELETE FROM held WHERE name = ? AND (since < ? OR owner = ?)", (name, now - self.age, owner))
            taken = self.db.execute("INSERT OR IGNORE INTO held VALUES (?, ?, ?)", (name, owner, now)).rowcount == 1
            self.db.execute("COMMIT")
            return taken
        except BaseException:
            self.db.execute("ROLLBACK")
            raise

    def release(self, name: str, owner: str) -> bool:
        return self.db.execute("DELETE FROM held WHERE name = ? AND owner = ?", (name, owner)).rowcount == 1

    def expire(self, now: float | None = None) -> int:
        """Removes all locks that are too old; gives their number."""
        return self.db.execute("DELETE FROM held WHERE since < ?", ((time.time() if now is None else now) - self.age,)).rowcount
