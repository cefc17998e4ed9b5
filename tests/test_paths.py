import os

import pytest

from arrayloom.model import ArrayFileError
from arrayloom.sources.paths import expand, first_file


@pytest.fixture()
def folder(tmp_path):
    for name in ("order_2.h5", "order_10.h5", "order_1.h5", ".hidden.h5", "a/x.h5", "a/b/y.h5", ".d/z.h5", "literal[1].h5"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"")
    (tmp_path / "dir[1]").mkdir()
    os.symlink(tmp_path / "a", tmp_path / "link")
    return tmp_path


def names(folder, found):
    return [os.path.relpath(f, folder) for f in found]


def test_patterns_sort_by_name_and_match_dot_files(folder):
    assert names(folder, expand(f"{folder}/order_*.h5", "read")) == ["order_1.h5", "order_10.h5", "order_2.h5"]
    assert ".hidden.h5" in names(folder, expand(f"{folder}/*.h5", "read"))
    assert names(folder, expand(f"{folder}/order_[12].h5", "read")) == ["order_1.h5", "order_2.h5"]
    assert names(folder, expand(f"{folder}/order_?.h5", "read")) == ["order_1.h5", "order_2.h5"]


def test_double_star_descends_but_not_through_links(folder):
    found = names(folder, expand(f"{folder}/**/*.h5", "read"))
    assert "a/b/y.h5" in found and ".d/z.h5" in found and not any(f.startswith("link/") for f in found)
    assert names(folder, expand(f"{folder}/link/*.h5", "read")) == ["link/x.h5"]
    with pytest.raises(ArrayFileError, match="multiple"):
        expand(f"{folder}/**/a/**/x.h5", "read")


def test_names_with_wildcards_fall_back_to_files_only(folder):
    assert names(folder, expand(f"{folder}/literal[1].h5", "read")) == ["literal[1].h5"]
    for missing in ("dir[1]", "no_*"):
        with pytest.raises(ArrayFileError, match="No files found"):
            expand(f"{folder}/{missing}", "read")


def test_lists_keep_order_and_repeats(folder):
    two = [f"{folder}/order_2.h5", f"{folder}/order_1*.h5", f"{folder}/order_2.h5"]
    assert names(folder, expand(two, "read")) == ["order_2.h5", "order_1.h5", "order_10.h5", "order_2.h5"]
    for bad, message in (([], "at least one"), ([None], "NULL input"), (None, "NULL list")):
        with pytest.raises(ArrayFileError, match=message):
            expand(bad, "tree")


def test_first_file(folder):
    assert first_file(None) is None
    assert first_file("not there.h5") == "not there.h5"
    assert names(folder, [first_file([f"{folder}/order_*.h5", "x"])]) == ["order_1.h5"]
    with pytest.raises(ArrayFileError):
        first_file([])
