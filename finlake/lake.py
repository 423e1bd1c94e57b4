"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Paths of the layers below one root URI (any file system Spark can reach)."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/cvm/{table}"

    def dimension(self, name: str) -> str:
        return f"{self.root}/gold/dimensoes/{name}"

    def fact(self, name: str) -> str:
        return f"{self.root}/gold/fatos/{name}"

    def log(self, name: str) -> str:
        return f"{self.root}/log/{name}"
