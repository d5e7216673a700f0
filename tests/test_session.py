import pytest

from finseries import session


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt, self.set_to = master, ckpt, None

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.set_to = d
        self.ckpt = d + "/uuid"


class _Conf:
    def get(self, key, default=None):
        return default

    def set(self, key, value):
        raise AssertionError("must not set core configs at run time")


class _Spark:
    def __init__(self, ctx):
        self.sparkContext, self.conf = ctx, _Conf()


def test_unset_checkpoint_dir_local_gets_private_folder():
    ctx = _Ctx("local[4]")
    root = session.scratch_root(_Spark(ctx))
    assert ctx.set_to and root == ctx.set_to
    assert session.scratch_root(_Spark(ctx)) == ctx.ckpt  # found again on the context


def test_unset_checkpoint_dir_on_cluster_is_an_error():
    with pytest.raises(RuntimeError):
        session.scratch_root(_Spark(_Ctx("yarn")))


def test_scratch_root_is_stable(spark):
    root = session.scratch_root(spark)
    assert root and session.scratch_root(spark) == root
