"""Dated, place-keyed observation analytics as Spark jobs.

Every operator is a function from DataFrame(s) to DataFrame. Nothing here starts a session,
keeps module state, or pulls rows to the driver.
"""
