"""Explicit schemas of the telemetry tables (DDL strings)."""

COUNTER_SAMPLES = """collection_time timestamp_ntz, server_name string, object_name string, counter_name string,
 instance_name string, cntr_value bigint, cntr_type int, id smallint"""
WAIT_SNAPSHOTS = """collection_time timestamp_ntz, row_num smallint, wait_type string, wait_s decimal(20,2),
 resource_s decimal(20,2), signal_s decimal(20,2), wait_count bigint, percentage decimal(5,2)"""
FILE_STATS = """server_name string, check_date timestamp_ntz, database_id int, database_name string, file_id int,
 type_desc string, physical_name string, size_mb bigint, io_stall_read_ms bigint, num_of_reads bigint, bytes_read bigint,
 io_stall_write_ms bigint, num_of_writes bigint, bytes_written bigint"""
SESSIONS = """collection_time timestamp_ntz, session_id bigint, blocking_session_id bigint, login_name string,
 program_name string, database_name string, sql_command string, wait_info string, status string,
 open_tran_count bigint, tran_start_time timestamp_ntz, start_time timestamp_ntz"""
TRACE = "statement string, executions bigint, cpu bigint, reads bigint, writes bigint, duration bigint, event_class int"
JOB_HISTORY = """job_name string, instance_id bigint, step_id int, step_name string, run_status int, run_date int,
 run_time int, run_duration int"""
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
