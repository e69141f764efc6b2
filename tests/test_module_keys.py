"""Module keys, spelling by spelling and place by place."""

import json

import pytest
from pyspark.sql import functions as F

from cohortkit.functions.keys import dataset_name, ip_number, opaque_course_id, plain_course_id, plain_module_id
from cohortkit.functions.modules import add_module_id
from cohortkit.operators.events import forum_action

NEW, OLD = "/courses/course-v1:Hill+Bio-7+2031_T1", "/courses/Hill/Bio-7/2031_T1"


def block(category, name, course="Hill+Bio-7+2031_T1"):
    return f"block-v1:{course}+type@{category}+block@{name}"


def row(want, kind="", event="", page="", path="", source="server"):
    return kind, event if isinstance(event, str) or event is None else json.dumps(event), page, path, source, want


ADDRESSES = [  # address as event type (or path), key
    (f"{NEW}/xblock/{block('problem', 'cells')}/handler/xmodule_handler/problem_check", "Hill/Bio-7/problem/cells"),
    (f"{NEW}/xblock/{block('html', 'intro')}", "Hill/Bio-7/html/intro"),
    (f"{NEW}/xblock/{block('html', 'a+b', 'Dale+Other+R')}/view", "Hill/Bio-7/html/a+b"),  # the course is the address's
    (f"{OLD}/xblock/i4x:;_;_Hill;_Bio-7;_video;_v1/handler/xmodule_handler", "Hill/Bio-7/video/v1"),
]
OLD_ONLY = [
    (f"{OLD}/courseware/week2/mitosis/", "Hill/Bio-7/sequential/mitosis/"), (f"{OLD}/courseware/week2/", "Hill/Bio-7/chapter/week2"),
    (f"{OLD}/courseware/week2/mitosis/3/", None), (f"{OLD}/courseware/", None),
    (f"{OLD}/jump_to_id/leaf", "Hill/Bio-7/jump_to_id/leaf"), (f"{OLD}/jump_to_id/leaf/", "Hill/Bio-7/jump_to_id/leaf"),
    (f"{OLD}/discussion/threads/5f1/reply", "Hill/Bio-7/forum/5f1"), (f"{OLD}/discussion/forum/week2/threads/5f2", "Hill/Bio-7/forum/5f2"),
    (f"{OLD}/discussion/i4xsection/threads/create", "Hill/Bio-7/forum/new"), (f"{OLD}/discussion/comments/9", None), (f"{OLD}/progress", None),
    ("i4x://Hill/Bio-7/video/v1/transcript", "Hill/Bio-7/video/v1"), ("i4x://Hill/Bio-7/video", None),
]
FIELD = "input_i4x-Hill-Bio7-problem-cells_2_1=choice_3&input_i4x-Hill-Bio7-problem-other_2_1=x"
PAYLOADS = [
    row("Hill/Bio-7/video/v1", event={"id": block("video", "v1")}), row("Hill/Bio-7/video/v1", event=block("video", "v1")),
    row("Hill/Bio-7/video/v1", event={"id": "i4x-Hill-Bio-7-video-v1"}),  # the course may hold dashes
    row("Hill/Bio-7/video/short", "play_video", {"id": "short"}, page=f"https://x.org{NEW}/courseware/week2/mitosis/"),
    row(None, "play_video", {"id": "short"}, page=f"https://x.org{NEW}/info"),
    row("Hill/Bio7/problem/cells", "problem_check", FIELD), row("Hill/Bio7/problem/cells", "problem_graded", [FIELD, "<div/>"]),
    row("Hill/Bio7/problem/cells", "save", FIELD), row("Hill/Bio7/problem/cells", "reset", [FIELD], source="browser"),
    row("Hill/Bio7/problem/a_3_b", "save", "input_i4x-Hill-Bio7-problem-a_3_b_2_1_comment=x", source="browser"),
    row("Hill/Bio-7/problem/cells", "problem_check", "input_cells_2_1=a", page=f"https://x.org{NEW}/courseware/w/s/"),
    row("Hill/Bio-7/problem/cells", "problem_graded", ["input_cells_2_1=a"], page=f"https://x.org{NEW}/bookmarks"),
    row("Hill/Bio-7/sequential/s1", event={"id": "i4x://Hill/Bio-7/sequential/s1"}, source="browser"),
    row("Hill/Bio-7/sequential/s1/4", "seq_next", {"id": "i4x://Hill/Bio-7/sequential/s1", "old": 3, "new": 4}, source="browser"),
    row("Hill/Bio-7/sequential/s1/2", "i4x://Hill/Bio-7/sequential/s1/goto_position", {"POST": {"position": ["2"]}}),
    row("Hill/Bio-7/sequential/mitosis/", "page_close", page=f"https://x.org{OLD}/courseware/week2/mitosis/##", source="browser"),
    row("Hill/Bio-7/chapter/week2/", "page_close", page=f"https://x.org{OLD}/courseware/week2/", source="browser"),
    row("Hill/Bio-7/problem/cells", "graded", {"problem_id": "i4x://Hill/Bio-7/problem/cells"}), row("Hill/Bio-7/html/h", event="see i4x://Hill/Bio-7/html/h"),
    row(None, "x", {"id": None, "problem_id": "i4x://Hill/Bio-7/problem/cells"}), row(None, "x", {}), row(None), (None,) * 6,
    *[row(None, kind, {"problem_id": "i4x://Hill/Bio-7/problem/cells"}) for kind in ("add_resource", "recommender_upvote")],
]
CASES = [row(want, kind=a) for a, want in ADDRESSES + OLD_ONLY] + [row(want, path=a) for a, want in ADDRESSES] + PAYLOADS


def test_module_key_rules(spark):
    schema = "n int, event_type string, event string, page string, path string, event_source string, want string"
    df = spark.createDataFrame([(i, *case) for i, case in enumerate(CASES)], schema)
    rows = add_module_id(df).orderBy("n").collect()
    assert not [(r.event_type, r.event, r.path, r.module_id, r.want) for r in rows if r.module_id != r.want]
    assert add_module_id(df).columns == [*df.columns, "module_id"]


def test_forum_actions(spark):
    at = f"{NEW}/discussion"
    want = {
        f"{at}/threads/5f1/reply": "reply", f"{at}/threads/5f1/follow": "follow_thread", f"{at}/threads/5f1/unfollow": "unfollow_thread",
        f"{at}/threads/5f1/flagAbuse": f"{at}/threads/5f1/flagAbuse", f"{at}/comments/9/upvote": "comment_upvote",
        f"{at}/comments/9/pin": f"{at}/comments/9/pin", f"{at}/forum": "enter_forum", f"{at}/forum/": "enter_forum",
        f"{at}/forum/search": "search", f"{at}/forum/week2/inline": "read_inline", f"{at}/forum/week2/threads/5f1": "read",
        f"{at}/forum/users/12": "target_user", f"{at}/forum/users/12/followed": "follow_user",
        f"{NEW}/instructor/api/list-forum-members": "list-forum-members", "edx.forum.searched": "searched", "edx.forum.other": "edx.forum.other",
    }
    df = spark.createDataFrame([(k,) for k in want], "et string")
    got = {r.et: r.action for r in df.select("et", forum_action(F.col("et")).alias("action")).collect()}
    assert got == want


@pytest.mark.parametrize("fn,given,want", [
    (plain_course_id, "course-v1:Hill+Bio.7+2031_T1", "Hill/Bio.7/2031_T1"), (plain_course_id, "Hill/Bio/R", "Hill/Bio/R"),
    (plain_module_id, block("vertical", "V"), "i4x://Hill/Bio-7/vertical/V"),
    (opaque_course_id, "Hill/Bio/R", "course-v1:Hill+Bio+R"), (dataset_name, "Hill/Bio.7", "Hill__Bio_7"),
    (ip_number, "0.0.1.5", 261), (ip_number, "1.2.3", None)])
def test_keys(spark, fn, given, want):
    assert spark.createDataFrame([(given,)], "x string").select(fn(F.col("x"))).first()[0] == want
