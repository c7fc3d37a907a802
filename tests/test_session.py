"""The shared folder: the cluster's own, a temporary one in a single JVM, an error elsewhere."""

import pytest

from vacancia import session


class Stub:
    """Settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, *default):
        return self.settings.get(key, *default)


def test_the_setting_is_used_where_it_is_set():
    assert session.shared_folder(Stub(spark__checkpoint__dir="s3a://b/c/")) == "s3a://b/c"
    assert session.workspace(Stub(spark__checkpoint__dir="s3a://b/c")).startswith("s3a://b/c/vacancia-")


def test_one_temporary_folder_per_local_application():
    one, other = (Stub(spark__master="local[2]", spark__app__id=i) for i in ("one", "other"))
    assert session.shared_folder(one) == session.shared_folder(one) != session.shared_folder(other)


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Stub(spark__master="spark://host:7077", spark__app__id="x"))
