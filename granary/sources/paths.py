"""Layer locations below one base address (local path, abfss://, gs://, s3a:// ...)."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LakePaths:
    base: str

    def layer(self, name: str) -> str:
        if name not in LAYERS:
            raise ValueError(f"unknown layer {name!r}")
        return f"{self.base.rstrip('/')}/{name}"

    def table(self, layer: str, table: str) -> str:
        return f"{self.layer(layer)}/{table}"


def azure(container: str, account: str, root: str = "") -> LakePaths:
    return LakePaths(f"abfss://{container}@{account}.dfs.core.windows.net/{root}".rstrip("/"))


def google(bucket: str, root: str = "") -> LakePaths:
    return LakePaths(f"gs://{bucket}/{root}".rstrip("/"))


def amazon(bucket: str, root: str = "") -> LakePaths:
    return LakePaths(f"s3a://{bucket}/{root}".rstrip("/"))


def local(root: str) -> LakePaths:
    return LakePaths(f"file://{root}" if root.startswith("/") else root)
