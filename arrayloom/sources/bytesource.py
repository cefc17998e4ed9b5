"""Random reads of a file's bytes, local or over HTTP ranges, with a small cache of blocks for remote files."""

from __future__ import annotations

import functools
import os
import urllib.error
import urllib.request
from collections import OrderedDict

from arrayloom.model import ArrayFileError

#: Reads below a block's size go through the cache of a remote file.
BLOCK_BYTES, BLOCKS = 30 * 1024, 100


class LocalBytes:
    def __init__(self, path: str):
        try:
            self.fd = os.open(path, os.O_RDONLY)
            if os.path.isdir(path):
                os.close(self.fd)
                raise OSError("is a directory")
        except OSError as e:
            raise ArrayFileError(f"Failed to open HDF5 file: {path}") from e
        self.path, self.stamp = path, self._stamp(os.fstat(self.fd))
        self.size = self.stamp[2]

    @staticmethod
    def _stamp(s: os.stat_result) -> tuple:
        return s.st_ino, s.st_mtime_ns, s.st_size

    def changed(self) -> bool:
        """Whether another process has replaced or written the file since it was opened."""
        try:
            return self._stamp(os.stat(self.path)) != self.stamp
        except OSError:
            return True

    def read(self, offset: int, n: int) -> bytes:
        out = os.pread(self.fd, n, offset)
        while len(out) < n:
            more = os.pread(self.fd, n - len(out), offset + len(out))
            if not more:
                raise ArrayFileError(f"Attempted to read beyond end of file ({offset + n} > {self.size})")
            out += more
        return out

    def close(self) -> None:
        os.close(self.fd)


class HttpBytes:
    """A file read by HTTP ranges."""

    def __init__(self, url: str, timeout: float = 30.0):
        self.url, self.timeout = url, timeout
        self.kept: OrderedDict[int, bytes] = OrderedDict()
        try:
            with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=timeout) as r:
                self.size = int(r.headers["Content-Length"])
        except (urllib.error.URLError, TypeError, OSError) as e:
            raise ArrayFileError(f"Failed to open HDF5 file: {url}") from e

    def _fetch(self, offset: int, n: int) -> bytes:
        request = urllib.request.Request(self.url, headers={"Range": f"bytes={offset}-{offset + n - 1}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as r:
            out = r.read()
        return out[offset : offset + n] if r.status == 200 else out  # a server without ranges sends it all

    def read(self, offset: int, n: int) -> bytes:
        if offset + n > self.size:
            raise ArrayFileError(f"Attempted to read beyond end of remote file ({self.url})")
        if n >= BLOCK_BYTES:
            return self._fetch(offset, n)
        out = b""
        if not n:
            return out
        for i in range(offset // BLOCK_BYTES, (offset + n - 1) // BLOCK_BYTES + 1):
            block = self.kept.pop(i, None)
            if block is None:
                block = self._fetch(i * BLOCK_BYTES, min(BLOCK_BYTES, self.size - i * BLOCK_BYTES))
            self.kept[i] = block
            if len(self.kept) > BLOCKS:
                self.kept.popitem(last=False)
            out += block[max(0, offset - i * BLOCK_BYTES) : offset + n - i * BLOCK_BYTES]
        return out

    def close(self) -> None:
        self.kept.clear()


#: Access to SFTP servers, by host name. Set on the driver; each read sends what is known when it is planned to its tasks.
sftp_access: dict = {}


def adopt(access: dict) -> None:
    """Makes access known to this process; by its name, as a copy of the table would be no use."""
    sftp_access.update(access)


def with_access(f):
    """``f`` for a task, which knows the access that the driver knows now."""
    access = dict(sftp_access)

    @functools.wraps(f)
    def run(*args):
        adopt(access)
        return f(*args)

    return run if access else f


def open_bytes(path: str):
    from arrayloom.sources import remote

    scheme = path.partition("://")[0] if "://" in path else "file"
    if scheme == "file":
        return LocalBytes(path.removeprefix("file://"))
    if scheme == "sftp":
        return remote.SftpBytes(path, sftp_access.get(remote.parse_sftp(path)[0]))
    plain = remote.plain_uri(path)
    return HttpBytes(plain) if plain.startswith(("http://", "https://")) else remote.StoreBytes(path)
