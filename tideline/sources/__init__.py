"""Snapshots, change streams, JDBC tables and topics."""
