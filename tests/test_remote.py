import os

import pytest

from arrayloom.model import ArrayFileError
from arrayloom.sources.paths import expand
from arrayloom.sources.remote import SftpAccess, StoreBytes, expand_store, parse_sftp, pattern_regex, plain_uri


def test_schemes():
    assert plain_uri("s3a://b/x") == "s3://b/x" and plain_uri("gcs://b/x") == "gs://b/x"
    assert plain_uri("hf://datasets/o/r@v2/a/b.h5") == "https://huggingface.co/datasets/o/r/resolve/v2/a/b.h5"


@pytest.mark.parametrize(
    "pattern,yes,no",
    [("a/*.h5", ["a/x.h5", "a/.h.h5"], ["a/b/x.h5", "x.h5"]), ("a/**/x?.h5", ["a/x1.h5", "a/b/c/x2.h5"], ["a/x.h5"]), ("[!a]b", ["cb"], ["ab", "/b"]), ("a[1-3]+", ["a2+"], ["a4+", "a22"])],
)
def test_patterns(pattern, yes, no):
    match = pattern_regex(pattern).fullmatch
    assert all(map(match, yes)) and not any(map(match, no))


def test_a_store(tmp_path):
    from pyarrow import fs

    (tmp_path / "d" / "e").mkdir(parents=True)
    for name in ("d/b.h5", "d/a.h5", "d/e/c.h5"):
        (tmp_path / name).write_bytes(b"0123456789")
    files = fs.LocalFileSystem()
    found = expand_store(f"s3://{tmp_path}/d/*.h5", (files, f"{tmp_path}/d/*.h5"))
    assert found == [f"s3://{tmp_path}/d/a.h5", f"s3://{tmp_path}/d/b.h5"]
    assert len(expand_store(f"s3://{tmp_path}/d/**/*.h5", (files, f"{tmp_path}/d/**/*.h5"))) == 3
    with pytest.raises(ArrayFileError, match="No files found"):
        expand_store("s3://x", (files, f"{tmp_path}/d/*.no"))
    b = StoreBytes("s3://x", (files, f"{tmp_path}/d/a.h5"))
    assert b.read(3, 4) == b"3456" and b.size == 10
    with pytest.raises(ArrayFileError, match="beyond end"):
        b.read(8, 4)
    with pytest.raises(ArrayFileError, match="Failed to open"):
        StoreBytes("s3://x", (files, f"{tmp_path}/none"))


def test_sftp_urls():
    known = SftpAccess("me", password="p", host_key_fingerprint="SHA256:x", port=2_222)
    assert parse_sftp("sftp://host/a%20b.h5") == ("host", 22, "/a b.h5")
    assert parse_sftp("sftp://[::1]:2222/x", known) == ("::1", 2_222, "/x")
    for bad in ("sftp://me@host/x", "sftp://host:22/x", "sftp://host:bad/x", "sftp://host", "http://host/x"):
        with pytest.raises(ArrayFileError):
            parse_sftp(bad, known)


@pytest.mark.parametrize(
    "options",
    [{"username": ""}, {"username": "a"}, {"username": "a", "password": "p", "use_agent": True, "known_hosts_path": "k"}, {"username": "a", "password": "p"}, {"username": "a", "password": "p", "known_hosts_path": "k", "port": 0}, {"username": "a", "use_agent": True, "key_passphrase": "x", "known_hosts_path": "k"}],
)
def test_sftp_access_must_be_whole(options):
    with pytest.raises(ArrayFileError):
        SftpAccess(**options)


class Server:
    """Stands in for the library's client: serves a folder of this machine."""

    root, active, logins = "", True, 0

    def __init__(self):
        Server.logins += 1

    def load_host_keys(self, path): ...

    def set_missing_host_key_policy(self, policy): ...

    def connect(self, host, port, user, **options):
        assert (host, port, user, options["password"]) == ("box", 22, "me", "p")

    def get_transport(self):
        return self

    def is_active(self):
        return Server.active

    def close(self): ...

    def open_sftp(self):
        return self

    def listdir_attr(self, folder):
        out = []
        for e in os.scandir(self.root + folder):
            out.append(type("Entry", (), {"filename": e.name, "st_mode": e.stat().st_mode})())
        return out

    def open(self, path, mode):
        f = open(self.root + path, mode)
        f_stat = type("Stat", (), {"st_size": os.path.getsize(self.root + path)})
        return type("Remote", (), {"stat": lambda _: f_stat, "seek": lambda _, n: f.seek(n), "read": lambda _, n: f.read(n), "close": lambda _: f.close()})()


def test_sftp_files_and_patterns(tmp_path, monkeypatch):
    import sys
    import types

    from arrayloom.sources import bytesource, remote

    for name in ("d/a.h5", "d/b.h5", "d/e/c.h5", "d/x.txt"):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(b"0123456789")
    monkeypatch.setitem(sys.modules, "paramiko", types.SimpleNamespace(SSHClient=Server, Transport=object))
    monkeypatch.setattr(Server, "root", str(tmp_path))
    monkeypatch.setattr(remote, "_sessions", {})
    monkeypatch.setitem(bytesource.sftp_access, "box", SftpAccess("me", password="p", host_key_fingerprint="SHA256:x"))
    assert expand("sftp://box/d/*.h5", "read") == ["sftp://box/d/a.h5", "sftp://box/d/b.h5"]
    assert expand("sftp://box/d/**/?.h5", "read") == ["sftp://box/d/a.h5", "sftp://box/d/b.h5", "sftp://box/d/e/c.h5"]
    assert expand("sftp://box/d/a.h5", "read") == ["sftp://box/d/a.h5"]
    with pytest.raises(ArrayFileError, match="No files found"):
        expand("sftp://box/d/*.no", "read")
    b = bytesource.open_bytes("sftp://box/d/b.h5")
    assert b.size == 10 and b.read(2, 3) == b"234" and Server.logins == 1
    Server.active = False
    assert bytesource.open_bytes("sftp://box/d/a.h5").read(0, 2) == b"01" and Server.logins == 2
    Server.active = True


def test_tasks_know_the_access(spark, monkeypatch):
    from arrayloom import api
    from arrayloom.sources import bytesource

    rows = spark.createDataFrame([("sftp://box/x.h5", "/")], "f string, g string")
    with pytest.raises(Exception, match="No SFTP access"):
        rows.select(api.ls_value()("f", "g")).collect()
    monkeypatch.setitem(bytesource.sftp_access, "box", SftpAccess("me", password="p", host_key_fingerprint="SHA256:x"))
    with pytest.raises(Exception, match="paramiko"):
        rows.select(api.ls_value()("f", "g")).collect()
