"""Registered queries, their check SQL, and the batch plan from bronze to gold."""
