"""Cleaning, windowing and anomaly scoring of sensor observations on Spark."""
