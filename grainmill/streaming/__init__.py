"""grainmill.streaming"""
