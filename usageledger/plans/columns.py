"""Source columns of the nineteen histories.

A load reads these as far as its source has them. A column that a source gains is
left out until it is listed here.
"""

# The columns of each source, in the order they are stored.
SOURCE_COLUMNS = {
    "auto_clustering": """
        start_time end_time table_id table_name schema_name database_name credits_used num_bytes
        num_bytes_reclustered num_rows_reclustered""",
    "mv_refresh": "start_time end_time table_name schema_name database_name credits_used",
    "replication": "start_time end_time database_name credits_used",
    "search_optimization": """
        start_time end_time credits_used table_id table_name schema_id schema_name database_id database_name""",
    "serverless_task": """
        start_time end_time credits_used task_id task_name schema_id schema_name database_id database_name""",
    "copy_history": """
        file_name stage_location last_load_time row_count row_parsed file_size first_error_message
        first_error_line_number first_error_character_pos first_error_column_name error_count error_limit status
        table_id table_name table_schema_id table_schema_name table_catalog_id table_catalog_name
        pipe_catalog_name pipe_schema_name pipe_name pipe_received_time""",
    "load_history": """
        table_id table_name schema_id schema_name catalog_id catalog_name file_name last_load_time status row_count
        row_parsed first_error_message first_error_line_number first_error_character_position first_error_col_name
        error_count error_limit""",
    "database_storage": "usage_date database_name database_id average_database_bytes average_failsafe_bytes",
    "account_storage": "usage_date storage_bytes stage_bytes failsafe_bytes",
    "pipe_credit": """
        start_time end_time pipe_id pipe_name service_type credits_used start_date operation_hours time_of_day
        pipe_schema pipe_database pipe_owner""",
    "query_history": """
        query_id query_text database_id database_name schema_id schema_name query_type session_id user_name role_name
        warehouse_id warehouse_name warehouse_size warehouse_type cluster_number query_tag execution_status error_code
        error_message start_time end_time total_elapsed_time bytes_scanned percentage_scanned_from_cache bytes_written
        bytes_written_to_result bytes_read_from_result rows_produced rows_inserted rows_updated rows_deleted
        rows_unloaded bytes_deleted partitions_scanned partitions_total bytes_spilled_to_local_storage
        bytes_spilled_to_remote_storage bytes_sent_over_the_network compilation_time execution_time
        queued_provisioning_time queued_repair_time queued_overload_time transaction_blocked_time
        outbound_data_transfer_cloud outbound_data_transfer_region outbound_data_transfer_bytes
        inbound_data_transfer_cloud inbound_data_transfer_region inbound_data_transfer_bytes list_external_files_time
        credits_used_cloud_services release_version external_function_total_invocations
        external_function_total_sent_rows external_function_total_received_rows external_function_total_sent_bytes
        external_function_total_received_bytes query_load_percent""",
    "reader_query_history": """
        reader_account_name query_id query_text query_type session_id user_name role_name schema_id schema_name
        database_id database_name warehouse_id warehouse_name warehouse_size warehouse_type cluster_number query_tag
        execution_status error_code error_message start_time end_time total_elapsed_time bytes_scanned rows_produced
        compilation_time execution_time queued_provisioning_time queued_repair_time queued_overload_time
        transaction_blocked_time outbound_data_transfer_cloud outbound_data_transfer_region
        outbound_data_transfer_bytes inbound_data_transfer_cloud inbound_data_transfer_region
        inbound_data_transfer_bytes list_external_files_time credits_used_cloud_services reader_account_deleted_on""",
    "reader_warehouse_credit": """
        reader_account_name start_time end_time warehouse_id warehouse_name credits_used credits_used_compute
        credits_used_cloud_services""",
    "sessions": "session_id created_on user_name client_application_id event_type is_success",
    "task_history": """
        query_id task_name database_name schema_name query_text state error_code error_message scheduled_time
        query_start_time completed_time root_task_id graph_version run_id return_value""",
    "warehouse_credit": """
        start_time end_time entity_id name service_type credits_used credits_used_compute credits_used_cloud_services
        start_date operation_hours time_of_day""",
    "org_currency": """
        organization_name contract_number account_name account_locator region service_level usage_date usage_type
        currency usage usage_in_currency""",
    "org_rate_sheet": """
        rate_date organization_name contract_number account_name account_locator region service_level usage_type
        currency effective_rate service_type""",
    "org_metering": """
        organization_name account_name account_locator region start_time end_time warehouse_id warehouse_name
        credits_used credits_used_compute credits_used_cloud_services service_type""",
}


def columns_of(report: str) -> tuple[str, ...]:
    return tuple(SOURCE_COLUMNS[report].split())
