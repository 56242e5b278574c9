"""Errors a caller can tell apart: a missing table is not a bad argument."""


class RoadlensError(Exception):
    """Base of every error raised on purpose by this package."""


class UnknownTable(RoadlensError):
    def __init__(self, name: str):
        super().__init__(f"no such table: {name}")
        self.name = name


class UnknownColumn(RoadlensError):
    def __init__(self, name: str, known):
        super().__init__(f"no such column: {name} (have: {', '.join(known)})")
        self.name = name


class BadPage(RoadlensError):
    """limit or offset outside the allowed range."""


class NoSnapshotDate(RoadlensError):
    """A feed without a single parsable situation date cannot be filed under a day."""


class NoSharedFolder(RoadlensError):
    """A cluster session names no folder that all its executors can reach."""


class CommitConflict(RoadlensError):
    """Other writers were faster again and again."""

    def __init__(self, base: str):
        super().__init__(f"too many writers at {base}")


class RepeatedIds(RoadlensError):
    """A table said to hold each id once holds some more often."""

    def __init__(self, ids: int, example):
        super().__init__(f"{ids} ids have more than one row, such as {example}")
