"""grainmill.plans"""
