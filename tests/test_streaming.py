import os
import uuid

from strata.streaming import start_ranking

TERMS = ["basil", "mace"]


def add(folder, name, *texts):
    with open(os.path.join(folder, name), "w") as f:
        for i, t in enumerate(texts):
            f.write(f"<page><title>x{name}{i}</title><text>{t}</text></page>xx\n")


def shown(session, name):
    return [tuple(r) for r in session.sql(f"SELECT * FROM {name}").collect()]


def test_running_ranking_over_arriving_files(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    add(src, "a.txt", "a leaf of basil")
    name = "ranking_" + uuid.uuid4().hex[:8]
    q = start_ranking(spark, src, TERMS, name, os.path.join(scratch, "progress"))
    try:
        q.processAllAvailable()
        assert shown(spark, name) == [("basil", 1)]
        add(src, "b.txt", "mace with basil", "mace mace")
        q.processAllAvailable()
        assert shown(spark, name) == [("basil", 2), ("mace", 2)]
    finally:
        q.stop()


def test_another_session_resumes_from_the_named_folder(spark, scratch):
    src, folder = os.path.join(scratch, "in"), os.path.join(scratch, "progress")
    os.makedirs(src)
    add(src, "a.txt", "basil mace")
    name = "resume_" + uuid.uuid4().hex[:8]
    for session, want in ((spark, [("basil", 1), ("mace", 1)]),
                          (spark.newSession(), [("basil", 2), ("mace", 1)])):
        q = start_ranking(session, src, TERMS, name, folder)
        try:
            q.processAllAvailable()
            assert shown(session, name) == want     # counts kept, file a not read again
            read = sum(p["numInputRows"] for p in q.recentProgress)
            assert read == 1
        finally:
            q.stop()
        add(src, "b.txt", "fresh basil")
