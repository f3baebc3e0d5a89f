from veridq.session import work_dir


class _Conf:
    def get(self, key, default=None):
        return default

    def set(self, key, value):  # the real key is static: setting it must not be attempted
        raise AssertionError("spark.checkpoint.dir set at runtime")


class _Ctx:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = "file:" + d


class _Session:
    conf = _Conf()

    def __init__(self):
        self.sparkContext = _Ctx()


def test_work_dir_falls_back_to_context_checkpoint_dir():
    s = _Session()
    d = work_dir(s)
    assert d.startswith("file:") and s.sparkContext.dir == d
    assert work_dir(s) == d  # stable afterwards


def test_work_dir_prefers_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert work_dir(spark) == configured.rstrip("/")
