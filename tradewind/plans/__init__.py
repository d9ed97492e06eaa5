"""Staging, marts, reports and the forecast, composed from the operators."""
