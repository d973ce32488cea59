"""Inputs: landed JSON text, JSON array documents, the calendar, seeds and
the event fixture derived from the driver's ``events`` table."""
