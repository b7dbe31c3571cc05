"""Small hand-built attendance and MBR inputs with the edge rows of FIXTURES.md §E."""

import datetime as dt

from rollbook.sources.tables import TableRegistry

D = dt.date
TS = dt.datetime


def attendance_tables(spark) -> TableRegistry:
    t = TableRegistry(spark)
    t.register("alt_accounts", spark.createDataFrame([
        ("u1", "u1alt", "ann@x.org", "ann.alt@x.org"),
        ("u2", None, "bob@x.org", "bob.other@x.org"),
    ], "primary_user_service_id string, primary_alt_account_user_service_id string, "
       "primary_id_email string, alt_account_email string"))
    t.register("user_links", spark.createDataFrame([
        ("u1", "u1"), ("u2", "L2"), ("u3", "u3"),
    ], "primary_user_service_id string, user_service_id string"))
    t.register("participant_sessions", spark.createDataFrame([
        # u1 on two devices, overlapping, in lesson A (meeting 3600 s)
        ("m1", "i1", "u1", "ann@x.org", "Ann", "p1", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 10, 30), 1800, False),
        ("m1", "i1", "u1", "ann@x.org", "Ann", "p2", TS(2025, 1, 6, 10, 20), TS(2025, 1, 6, 10, 40), 1200, False),
        # u2: exactly half of lesson A
        ("m1", "i1", "u2", "bob@x.org", "Bob", "p3", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 10, 30), 1800, False),
        # staff account: excluded
        ("m1", "i1", "u9", "coach@company.com", "Coach", "p4", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 11, 0),
         3600, False),
        # null duration: excluded
        ("m1", "i1", "u3", "cy@x.org", "Cy", "p5", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 11, 0), None, False),
        # u3 attends lesson B (Monday of week 2) fully
        ("m2", "i2", "u3", "cy@x.org", "Cy", "p6", TS(2025, 1, 13, 10, 0), TS(2025, 1, 13, 11, 0), 3600, False),
    ], "meeting_id string, meeting_instance_id string, primary_user_service_id string, participant_email string, "
       "participant_name string, participant_meeting_instance_id string, join_time timestamp_ntz, "
       "leave_time timestamp_ntz, duration long, is_infered_optional_meeting boolean"))
    t.register("meeting_instances", spark.createDataFrame([
        ("i1", "P1", "A", "Lesson A", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 11, 0), 3600, False),
        ("i2", "P1", "B", "Lesson B", TS(2025, 1, 13, 10, 0), TS(2025, 1, 13, 11, 0), 3600, False),
    ], "meeting_instance_id string, program_code string, lesson_id string, lesson_title string, "
       "start_time_ts timestamp_ntz, end_time_ts timestamp_ntz, meeting_duration_seconds long, "
       "is_infered_optional_meeting boolean"))
    t.register("learners", spark.createDataFrame([
        ("u1", "ann@x.org", "Ann", "Lee", "P1", "ENROLLED", True, False),
        ("L2", "bob@x.org", "Bob", "Ray", "P1", "ENROLLED", True, False),
        ("u3", "cy@x.org", "Cy", "Ng", "P1", "ENROLLED", True, False),
        ("L4", "old@x.org", "Old", "Row", "P1", "ENROLLED", False, False),  # not current
    ], "user_service_id string, email string, first_name string, last_name string, program_code string, "
       "enrollments_status string, edw_is_current boolean, edw_is_deleted boolean"))
    t.register("lectures", spark.createDataFrame([
        ("A", "Lesson A", TS(2025, 1, 6, 10, 0), TS(2025, 1, 6, 11, 0), "P1", True, False),
        ("B", "Lesson B", TS(2025, 1, 13, 10, 0), TS(2025, 1, 13, 11, 0), "P1", True, False),
        ("C", "Spring break", TS(2025, 1, 20, 10, 0), TS(2025, 1, 20, 11, 0), "P1", True, False),
        ("D", None, TS(2025, 1, 21, 10, 0), TS(2025, 1, 21, 11, 0), "P1", True, False),  # no title
    ], "lesson_id string, lesson_title string, lesson_start_date_ts timestamp_ntz, "
       "lesson_end_date_ts timestamp_ntz, program_code string, edw_is_current boolean, edw_is_deleted boolean"))
    t.register("program_content", spark.createDataFrame([
        ("Lesson B", "P1", TS(2025, 1, 13, 9, 0), TS(2025, 1, 13, 11, 0), "core"),
    ], "lesson_event string, program_code string, delivery_ts timestamp_ntz, lecture_end_ts timestamp_ntz, "
       "category string"))
    t.register("excused_absences", spark.createDataFrame([
        ("F1", "P1", D(2025, 1, 6), TS(2025, 1, 5, 8, 0), "sick", "bob@x.org", "Bob", "Ray"),
        ("F1", "P1", D(2025, 1, 6), TS(2025, 1, 5, 9, 0), "doctor", "bob@x.org", "Bob", "Ray"),  # later wins
        ("F1", "P1", None, TS(2025, 1, 5, 9, 0), "x", "bob@x.org", "Bob", "Ray"),  # null date dropped
        ("F1", "P1", D(2025, 1, 13), TS(2025, 1, 12, 9, 0), "trip", "ann.alt@x.org", "Ann", "Lee"),  # alt email
    ], "form_id string, program_code string, excused_attendance_date date, submitted_at timestamp_ntz, "
       "excuse_reason string, email string, first_name string, last_name string"))
    t.register("learner_activity", spark.createDataFrame([
        ("u3", "P1", "B", "lesson", '{"is_required": false}'),
        ("u3", "P1", "A", "lesson", '{"optional": "true"}'),
    ], "learner_id string, program_id string, activity_id string, activity_type string, overrides string"))
    t.register("programs", spark.createDataFrame([
        ("P1", TS(2025, 1, 8, 0, 0), TS(2025, 2, 14, 0, 0), "Cert A"),
    ], "program_code string, program_start_ts timestamp_ntz, program_end_ts timestamp_ntz, "
       "sponsored_industry_certification string"))
    t.register("form_questions", spark.createDataFrame([
        (f"QUESTION_ID_{i}", "form_id_001") for i in range(1, 7)], "question_id string, form_id string"))
    t.register("form_responses", spark.createDataFrame([
        ("question_id_1", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "P1"),
        ("question_id_2", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "  CY@X.ORG "),
        ("question_id_3", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "Monday"),
        ("question_id_4", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "2025-01-13"),
        ("question_id_5", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "2025-01-14"),
        ("question_id_6", "FORM_ID_001", TS(2025, 1, 10, 0, 0), "travel"),
    ], "question_id string, form_id string, submitted_at timestamp_ntz, response string"))
    return t


def mbr_tables(spark) -> TableRegistry:
    t = TableRegistry(spark)
    summary_schema = (
        "client_program_name string, program_code string, country string, start_date date, end_date date, "
        "months_since_completion string, admitted long, enrolled_or_graduated long, dropped_out long, "
        "placed_fellows long, beyond long, direct_beyond long, indirect_beyond long, internal_hire long, "
        "external_qualifying long, internal_training long, program_revenue double, cost_per_placement double, "
        "cost_per_placement_without_beyond double, program_nps double, placed_without_indirect long, "
        "beyond_without_indirect long")
    t.register("mbr_summary", spark.createDataFrame([
        ("Data EU", "PX", "DEU", D(2024, 1, 1), D(2024, 6, 30), "7", 10, 8, 2, 4, 1, None, 1, 1, 1, 1,
         1000.0, 100.0, 90.0, 50.0, 3, 1),
        ("Data EU", "PX", "FRA", D(2024, 2, 1), D(2024, 7, 31), "12", 20, 16, 4, 0, 2, 1, 1, 1, 1, 1,
         None, 200.0, 150.0, None, 0, 2),
        ("Data EU", "PX", "USA", D(2024, 2, 1), D(2024, 7, 31), "Ongoing", 5, 5, 0, 1, 0, 0, 0, 0, 0, 0,
         10.0, 50.0, 50.0, 70.0, 1, 0),
        ("Solo", "PY", "ITA", D(2024, 3, 1), D(2024, 9, 30), "0", 7, 0, 7, 0, 0, 0, 0, 0, 0, 0,
         0.0, None, None, None, 0, 0),
        ("Zero", "PZ", "ESP", D(2024, 3, 1), D(2024, 9, 30), "abc", 3, 3, 0, 0, 0, 0, 0, 0, 0, 0,
         0.0, 10.0, 10.0, None, 0, 0),
        ("Zero", "PZ", "GBR", D(2024, 3, 1), D(2024, 9, 30), "abc", 3, 3, 0, 0, 0, 0, 0, 0, 0, 0,
         0.0, 30.0, 30.0, None, 0, 0),
    ], summary_schema))
    t.register("programs", spark.createDataFrame([
        ("PX", None, None, "Cloud Cert"), ("PZ", None, None, "Zero Cert"),
    ], "program_code string, program_start_ts timestamp_ntz, program_end_ts timestamp_ntz, "
       "sponsored_industry_certification string"))
    t.register("cert_updates", spark.createDataFrame([
        ("PX", "DEU", 3, 2, 4, 1, 0, 1, 0, 0, 0.5, None, 0.25),
        ("PX", "DEU", 1, None, 0, 0, 0, 0, 0, 0, 0.1, 0.2, None),
    ], "program_code string, country string, certification_attempted long, certification_received long, "
       "cert_eligible long, job_transitions_with_certificate long, external_qualifying_with_certificate long, "
       "internal_hire_with_certificate long, beyond_with_certificate long, "
       "internal_training_with_certificate long, percent_exam_attempted double, percent_of_graduated double, "
       "percent_of_job_transitions_with_certificate double"))
    t.register("mbr_backfill", spark.createDataFrame([
        (D(2025, 10, 31), "October 2025", "7-12 MO. SINCE GRADUATION", "Data EU", "PX", "DEU", D(2024, 1, 1),
         D(2024, 6, 30), "6", 10, 8, 2, 3, 1, 1, 1, 1, 0.375, 0.8, 0.0625, "Cloud Cert", 1, 1, 0.1, 0.1, 1,
         0.3, 0, 0, 0, 0, 2, 900.0, 100.0, 90.0, 40.0, TS(2025, 10, 31, 12, 0)),
        (None, "November 2025", "Ongoing", "Data EU", "PX", "USA", D(2024, 2, 1), D(2024, 7, 31), "Ongoing",
         5, 5, 0, 1, 0, 0, 0, 0, 0.2, 1.0, None, None, 0, 0, 0.0, 0.0, 0, 0.0, 0, 0, 0, 0, 0, 10.0, 50.0,
         50.0, 70.0, TS(2025, 11, 28, 12, 0)),
        (D(2025, 12, 5), "December 2025", "Ongoing", "Data EU", "PX", "USA", D(2024, 2, 1), D(2024, 7, 31),
         "Ongoing", 5, 5, 0, 1, 0, 0, 0, 0, 0.2, 1.0, None, None, 0, 0, 0.0, 0.0, 0, 0.0, 0, 0, 0, 0, 0,
         10.0, 50.0, 50.0, 70.0, TS(2025, 12, 5, 12, 0)),  # current month: filtered out
    ], "snapshot_date date, mbr_reference string, Phase string, Program_name string, Program_Code string, "
       "Country string, Start_date date, End_Date date, Months_Since_Completion string, Admitted long, "
       "Enrolled long, Dropped_Out long, Placed_Fellows long, Beyond long, Internal_Hire long, "
       "External_Qualifying long, Internal_Training long, Placement_Rate double, Retention_Rate double, "
       "Run_Rate double, Certificate_Name string, Certification_Attempted long, Certification_Received long, "
       "Percent_Exam_Attempted double, Percent_Of_Graduated double, Job_transitions_with_Certificate long, "
       "Percent_Of_Job_transitions_with_Certificate double, External_Qualifying_with_Certificate long, "
       "Internal_Hire_with_Certificate long, Beyond_with_Certificate long, "
       "Internal_Training_with_Certificate long, Cert_Eligible long, Program_Revenue double, "
       "Cost_Per_Placement double, Cost_Per_Placement_Without_Beyond double, Program_NPS double, "
       "last_snapshot_ts_est timestamp_ntz"))
    return t
