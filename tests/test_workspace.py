from types import SimpleNamespace

import pytest

from tidemark import workspace


class Context:
    applicationId = "app-1"

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(setting, context):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context
    )


def test_the_setting_is_used():
    context = Context("spark://host")
    got = workspace.root(session("hdfs://shared/ck/", context))
    assert got == "hdfs://shared/ck/tidemark/app-1" and context.folder is None


def test_a_folder_set_on_the_context_is_used():
    assert workspace.root(session(None, Context("yarn", "/shared"))).startswith("/shared/tidemark")


def test_own_folder_only_in_local_mode():
    local = session(None, Context("local[4]"))
    made = workspace.root(local)
    assert made == workspace.root(local) and "tidemark-" in made
    with pytest.raises(RuntimeError):
        workspace.root(session(None, Context("yarn")))


def test_the_session_has_a_folder(spark):
    assert workspace.root(spark).endswith(spark.sparkContext.applicationId)


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from tidemark import workspace

    def session(master, setting=None, on_context=None):
        context = SimpleNamespace(
            master=master, applicationId="app", getCheckpointDir=lambda: on_context
        )
        conf = SimpleNamespace(get=lambda key, default: setting or default)
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert workspace.root(session("spark://x", "s3a://b/c")) == "s3a://b/c/tidemark/app"
    assert workspace.root(session("spark://x", "file:/mnt/shared")).startswith("file:/mnt/shared")
    assert workspace.root(session("spark://x", None, "hdfs://n/c")).startswith("hdfs://n/c")
    for folder in ("file:/tmp/x", None):
        with pytest.raises(RuntimeError):
            workspace.root(session("spark://x", None, folder))
