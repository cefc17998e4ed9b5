"""Expansion of file names, patterns and lists of them, on the driver."""

from __future__ import annotations

import fnmatch
import os
import re

from arrayloom.model import ArrayFileError

MAGIC = re.compile(r"[*?\[]")


def _matcher(part: str):
    # Names that begin with a dot match like any others; "[!a]" negates.
    return re.compile(fnmatch.translate(part)).match


def _entries(folder: str):
    try:
        with os.scandir(folder or ".") as found:
            return sorted(found, key=lambda e: e.name)
    except OSError:
        return []


def _folders(folder: str):
    """A folder and all below it; links to folders are not followed."""
    yield folder
    for e in _entries(folder):
        if e.is_dir(follow_symlinks=False):
            yield from _folders(os.path.join(folder, e.name) if folder else e.name)


def _walk(folder: str, parts: list[str]):
    if not parts:
        return
    part, rest = parts[0], parts[1:]
    if part == "**":
        for f in _folders(folder):
            yield from _walk(f, rest or ["*"])
        return
    if not MAGIC.search(part):
        path = os.path.join(folder, part) if folder else part
        if rest:
            if os.path.isdir(path):
                yield from _walk(path, rest)
        elif os.path.isfile(path):
            yield path
        return
    match = _matcher(part)
    for e in _entries(folder):
        if match(e.name):
            path = os.path.join(folder, e.name) if folder else e.name
            if rest:
                if e.is_dir():
                    yield from _walk(path, rest)
            elif e.is_file():
                yield path


def is_remote(path: str) -> bool:
    return "://" in path and not path.startswith("file://")


def expand_one(pattern: str) -> list[str]:
    """The files of a pattern in order; a name without wildcards, or that of a remote file, stands for itself."""
    # A web address has no folders to list, and "?" begins its query.
    if not MAGIC.search(pattern) or pattern.startswith(("http://", "https://", "hf://")):
        return [pattern]
    parts = pattern.split("/")
    if parts.count("**") > 1:
        raise ArrayFileError("Cannot use multiple '**' in one path")
    if pattern.startswith("sftp://"):
        from arrayloom.sources.remote import expand_sftp

        return expand_sftp(pattern)
    if is_remote(pattern):
        from arrayloom.sources.remote import expand_store

        return expand_store(pattern)
    start = "/" if pattern.startswith("/") else ""
    found = sorted(set(_walk(start, [p for p in parts if p])), key=lambda p: p.encode("utf-8", "surrogateescape"))
    if found:
        return found
    if os.path.isfile(pattern):  # a file whose name has such characters
        return [pattern]
    raise ArrayFileError(f'No files found that match the pattern "{pattern}"')


def expand(files: str | list[str] | None, what: str) -> list[str]:
    """All files of a name, a pattern, or a list of either, left to right, repeats kept."""
    if files is None:
        raise ArrayFileError(f"{what} cannot take NULL list as parameter")
    if isinstance(files, str):
        return expand_one(files)
    if not files:
        raise ArrayFileError(f"{what} needs at least one file to read")
    if any(f is None for f in files):
        raise ArrayFileError(f"{what} reader cannot take NULL input as parameter")
    return [path for f in files for path in expand_one(f)]


def first_file(files: str | list[str] | None) -> str | None:
    """The first file of the input; an exact name is not looked up."""
    if files is None:
        return None
    if isinstance(files, str):
        return expand_one(files)[0]
    if not files:
        raise ArrayFileError("first_file needs at least one file to read")
    if any(f is None for f in files):
        raise ArrayFileError("first_file reader cannot take NULL input as parameter")
    return expand_one(files[0])[0]
