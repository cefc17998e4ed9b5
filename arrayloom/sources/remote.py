"""Files of object stores, through pyarrow's filesystems, and of SFTP servers, through paramiko where that is installed."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import unquote, urlsplit

from arrayloom.model import ArrayFileError

#: Schemes that mean another one.
SAME = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
STORES = {"s3", "gs", "hdfs", "abfs", "viewfs"}


def plain_uri(uri: str) -> str:
    """A URI under its usual scheme; files of model hubs as web addresses."""
    scheme, _, rest = uri.partition("://")
    if scheme == "hf":
        kind, owner, name, path = re.fullmatch(r"(datasets|spaces)/([^/]+)/([^/]+)/(.+)", rest).groups()
        name, _, revision = name.partition("@")
        return f"https://huggingface.co/{kind}/{owner}/{name}/resolve/{revision or 'main'}/{path}"
    return f"{SAME.get(scheme, scheme)}://{rest}"


@lru_cache(maxsize=64)
def store(scheme: str, host: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"{scheme}://{host}/x")[0]


def opened_store(uri: str):
    """(filesystem, path within it) of a URI."""
    parts = urlsplit(plain_uri(uri))
    if parts.scheme not in STORES:
        raise ArrayFileError(f"Failed to open HDF5 file: {uri} (unknown scheme {parts.scheme})")
    inner = parts.path if parts.scheme in ("hdfs", "viewfs") else f"{parts.netloc}{parts.path}"
    return store(parts.scheme, parts.netloc), inner


class StoreBytes:
    def __init__(self, uri: str, opened=None):
        files, path = opened or opened_store(uri)
        try:
            self.file = files.open_input_file(path)
            self.size = self.file.size()
        except OSError as e:
            raise ArrayFileError(f"Failed to open HDF5 file: {uri}") from e
        self.uri = uri

    def read(self, offset: int, n: int) -> bytes:
        if offset + n > self.size:
            raise ArrayFileError(f"Attempted to read beyond end of remote file ({self.uri})")
        return self.file.read_at(n, offset)

    def close(self) -> None:
        self.file.close()


def pattern_regex(pattern: str) -> re.Pattern:
    """The names that a pattern matches; "**" stands for any folders, none included."""
    out = ""
    for i, part in enumerate(pattern.split("/")):
        if part == "**":
            out += "(?:[^/]+/)*"
            continue
        at, own = 0, ""
        while at < len(part):
            c = part[at]
            end = part.find("]", at + 2) if c == "[" else -1
            if c == "*":
                own += "[^/]*"
            elif c == "?":
                own += "[^/]"
            elif end > 0:
                inner = part[at + 1 : end].replace("\\", "\\\\")
                own += "[" + ("^/" + inner[1:] if inner[0] == "!" else inner.replace("^", "\\^")) + "]"
                at = end
            else:
                own += re.escape(c)
            at += 1
        out += own + ("/" if i < pattern.count("/") else "")
    return re.compile(out)


def expand_store(uri: str, opened=None) -> list[str]:
    """The files of a store that a pattern matches, in order."""
    from pyarrow import fs

    files, path = opened or opened_store(uri)
    head = uri[: len(uri) - len(path)] if uri.endswith(path) else uri.partition("://")[0] + "://"
    fixed = re.split(r"[*?\[]", path, maxsplit=1)[0].rpartition("/")[0]
    match = pattern_regex(path)
    listed = files.get_file_info(fs.FileSelector(fixed, allow_not_found=True, recursive="/" in path[len(fixed) + 1 :] or "**" in path))
    found = sorted(f.path for f in listed if f.type == fs.FileType.File and match.fullmatch(f.path))
    if not found:
        raise ArrayFileError(f'No files found that match the pattern "{uri}"')
    return [head + f for f in found]


@dataclass(frozen=True)
class SftpAccess:
    """How to log in to a server and know it: one way to log in, at least one way to know the host."""

    username: str
    password: str | None = None
    key_path: str | None = None
    key_passphrase: str | None = None
    use_agent: bool = False
    known_hosts_path: str | None = None
    host_key_fingerprint: str | None = None
    port: int = 22
    host_key_algorithms: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if not self.username:
            raise ArrayFileError("SFTP access needs USERNAME")
        if sum([self.password is not None, self.key_path is not None, self.use_agent]) != 1:
            raise ArrayFileError("SFTP access needs exactly one of PASSWORD, KEY_PATH, or USE_AGENT")
        if self.key_passphrase is not None and self.key_path is None:
            raise ArrayFileError("SFTP KEY_PASSPHRASE needs KEY_PATH")
        if self.known_hosts_path is None and self.host_key_fingerprint is None:
            raise ArrayFileError("SFTP access needs KNOWN_HOSTS_PATH or HOST_KEY_FINGERPRINT")
        if not 0 < self.port < 65_536:
            raise ArrayFileError("SFTP PORT must be between 1 and 65535")


def parse_sftp(url: str, access: SftpAccess | None = None) -> tuple[str, int, str]:
    """(host, port, path) of a URL, which names no user and no other port than the access."""
    parts = urlsplit(url)
    if parts.scheme != "sftp" or not parts.hostname:
        raise ArrayFileError(f"Not an SFTP URL: {url}")
    if "@" in parts.netloc:
        raise ArrayFileError("SFTP URLs must not hold user names or passwords")
    try:
        port = parts.port
    except ValueError:
        raise ArrayFileError(f"Invalid port in SFTP URL: {url}") from None
    own = access.port if access else 22
    if port is not None and access is not None and port != own:
        raise ArrayFileError(f"Port {port} of the SFTP URL is not the access's port {own}")
    if not parts.path or parts.path == "/":
        raise ArrayFileError(f"No path in SFTP URL: {url}")
    return parts.hostname, port or own, unquote(parts.path)


#: Open connections by server and access.
_sessions: dict = {}


def sftp_session(url: str, access: SftpAccess | None):
    """(connection, path) of a URL; connections are kept, and opened anew where a server has closed them."""
    if access is None:
        raise ArrayFileError(f"No SFTP access is given for {url}")
    try:
        import paramiko
    except ImportError:
        raise ArrayFileError("SFTP needs the paramiko library") from None
    host, port, path = parse_sftp(url, access)
    key = host, port, access
    kept = _sessions.get(key)
    if kept is not None and (kept[0].get_transport() is None or not kept[0].get_transport().is_active()):
        kept[0].close()
        kept = None
    if kept is None:
        client = paramiko.SSHClient()
        if access.known_hosts_path:
            client.load_host_keys(access.known_hosts_path)
        client.set_missing_host_key_policy(_Fingerprint(access.host_key_fingerprint))
        options = {}
        if access.host_key_algorithms:  # all other kinds of host keys are refused
            known = getattr(paramiko.Transport, "_preferred_keys", ())
            options["disabled_algorithms"] = {"keys": [k for k in known if k not in access.host_key_algorithms]}
        client.connect(host, port, access.username, password=access.password, key_filename=access.key_path, passphrase=access.key_passphrase, allow_agent=access.use_agent, look_for_keys=False, **options)
        kept = _sessions[key] = client, client.open_sftp()
    return kept[1], path


def expand_sftp(url: str) -> list[str]:
    """The files of a server that a pattern matches, in order; folders are listed as far as the pattern needs."""
    from stat import S_ISDIR

    from arrayloom.sources.bytesource import sftp_access

    session, _ = sftp_session(url.replace("?", "%3F"), sftp_access.get(parse_sftp(url.replace("?", "%3F"))[0]))
    path = "/" + url.partition("://")[2].partition("/")[2]
    head = url[: len(url) - len(path)]
    fixed = re.split(r"[*?\[]", path, maxsplit=1)[0].rpartition("/")[0]
    match, deep = pattern_regex(path), "**" in path
    found, todo = [], [fixed or "/"]
    while todo:
        folder = todo.pop()
        try:
            entries = session.listdir_attr(folder)
        except OSError:
            continue
        for e in entries:
            name = f"{folder.rstrip('/')}/{e.filename}"
            if S_ISDIR(e.st_mode):
                if deep or name.count("/") < path.count("/"):
                    todo.append(name)
            elif match.fullmatch(name):
                found.append(name)
    if not found:
        raise ArrayFileError(f'No files found that match the pattern "{url}"')
    return [head + f for f in sorted(found, key=lambda f: f.encode("utf-8", "surrogateescape"))]


class SftpBytes:
    """A file of a server, read at offsets."""

    def __init__(self, url: str, access: SftpAccess | None):
        session, path = sftp_session(url, access)
        try:
            self.file = session.open(path, "rb")
            self.size = self.file.stat().st_size
        except OSError as e:
            raise ArrayFileError(f"Failed to open HDF5 file: {url}") from e
        self.url = url

    def read(self, offset: int, n: int) -> bytes:
        if offset + n > self.size:
            raise ArrayFileError(f"Attempted to read beyond end of remote file ({self.url})")
        self.file.seek(offset)
        return self.file.read(n)

    def close(self) -> None:
        self.file.close()


class _Fingerprint:
    """Accepts an unknown host if its key has the given SHA-256 fingerprint."""

    def __init__(self, wanted: str | None):
        self.wanted = wanted

    def missing_host_key(self, client, hostname, key):
        import base64
        import hashlib

        own = base64.b64encode(hashlib.sha256(key.asbytes()).digest()).rstrip(b"=").decode()
        if self.wanted is None or self.wanted.removeprefix("SHA256:").rstrip("=") != own:
            raise ArrayFileError(f"Unknown host key of {hostname}")
