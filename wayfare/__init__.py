"""Wayfare: DataFrame operators for cleaning, enriching, comparing and modelling trip feeds."""
