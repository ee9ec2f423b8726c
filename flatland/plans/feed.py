"""Feed configuration: one folder, one file layout, one chain of tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from flatland.sources.encodings import codec_name


@dataclass(frozen=True)
class Feed:
    """How the files of one folder are read and where they go.

    ``quoting`` follows the usual delimited-text modes: 0 minimal, 1 all,
    2 non-numeric (treated like 0), 3 none. ``delimiter`` is literal text
    (a real tab, not backslash-t). ``encoding`` may be spelt in any usual way.
    """

    name: str
    path: str
    extension: str = "txt"
    delimiter: str = "\t"
    encoding: str = "utf-8"
    null_value: str | None = "<NULL>"
    quoting: int = 3
    ignore: bool = False
    archive_expire_days: int | None = None
    log_expire_days: int | None = None
    # Quoted files larger than this are read in parallel splits of this size
    # (sources/quoted.py); unset means the session's maxPartitionBytes.
    quoted_split_bytes: int | None = None
    # The feed's own date layouts (Spark patterns), tried before the common ones.
    date_layouts: tuple[str, ...] = ()

    def __post_init__(self):
        if self.delimiter == "\\t":
            object.__setattr__(self, "delimiter", "\t")
        object.__setattr__(self, "encoding", codec_name(self.encoding))
        if self.quoting not in (0, 1, 2, 3):
            raise ValueError(f"quoting must be 0..3, got {self.quoting}")

    @property
    def quoted(self) -> bool:
        return self.quoting != 3

    def with_(self, **kw) -> "Feed":
        return replace(self, **kw)
