"""Operators for preparing training text. Each module holds one operator; ``workload`` registers their queries."""
