"""Table schemas of the pipeline, as DDL strings."""

RAW_EVENT = (
    "course string, time_text string, time_ts timestamp, row_key string, payload map<string,string>, "
    "source_file string, course_id string, inserted_at timestamp"
)
CANONICAL_EVENT = (
    "course_code string, ay string, term string, wydzial_code string, kierunek_code string, track_code string, "
    "semester_code string, ts_utc timestamp, teacher_id string, operation string, tech_key string, "
    "activity_label string, object_id string, count_mode string, row_key string, source_file string, counted boolean"
)
RULE = (
    "rule_no int, activity_label string, tech_key string, operation string, count_mode string, priority int, "
    "match_rx string, user_rx string, user_group int, object_rx string, object_group int"
)
SNAPSHOT = (
    "course_code string, activity_id string, name string, type string, visible_to_students boolean, "
    "captured_at timestamp, source_file string, row_key string"
)
ROSTER = (
    "course_id string, course_name string, users long, students long, teachers long, teachers_no_edit long, "
    "teachers_responsible long, students_enrolled long, students_done long, students_in_progress long, "
    "students_before_start long, row_key string, loaded_at timestamp"
)
