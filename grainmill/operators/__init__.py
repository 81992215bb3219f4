"""grainmill.operators"""
